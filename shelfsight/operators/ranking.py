"""Exact global positions and running totals without a single-task window.

A window without a partition key, or over one very large key, sorts everything in one
task. Here the rows are range-partitioned on the whole ordering key, summed inside each
slice, and shifted by the totals of the slices before it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfsight.operators.staging import stage

_SLICE = "__slice"


def running_totals(
    df: DataFrame,
    order_by: Sequence[Column],
    totals: Mapping[str, Column],
    by: Sequence[str] = (),
) -> DataFrame:
    """Add running sums over ``order_by`` (restarting per ``by``), each row included.

    ``order_by`` together with ``by`` must identify a row, or ties get an arbitrary but
    fixed order. The sliced rows are staged, because the range bounds come from a
    sample and both uses of the slices must see the same ones.
    """
    inputs = {name: f"__in_{name}" for name in totals}
    prepared = df.select("*", *(expr.alias(inputs[name]) for name, expr in totals.items()))
    order = list(order_by)
    sliced = stage(
        prepared.repartitionByRange(*(F.col(c) for c in by), *order).withColumn(
            _SLICE, F.spark_partition_id()
        )
    )
    inside = (
        Window.partitionBy(*by, _SLICE).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    )
    earlier = Window.partitionBy(*by).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    # one row per slice and group that reaches into it
    offsets = (
        sliced.groupBy(*by, _SLICE)
        .agg(*(F.sum(inputs[name]).alias(name) for name in totals))
        .select(
            *(F.col(c).alias(f"__{c}") for c in by),
            F.col(_SLICE).alias("__slice_no"),
            *(
                F.coalesce(F.sum(name).over(earlier), F.lit(0)).alias(f"__before_{name}")
                for name in totals
            ),
        )
    )
    same = reduce(
        lambda a, b: a & b,
        [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in by],
        F.col(_SLICE) == F.col("__slice_no"),
    )
    counted = sliced.select(
        "*", *(F.sum(inputs[name]).over(inside).alias(f"__local_{name}") for name in totals)
    )
    return counted.join(offsets, same, "inner").select(
        *df.columns,
        *((F.col(f"__local_{name}") + F.col(f"__before_{name}")).alias(name) for name in totals),
    )
