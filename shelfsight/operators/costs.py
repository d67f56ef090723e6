"""Unit costs per item."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfsight.functions import round_half_up


def unit_cost(lines: DataFrame) -> DataFrame:
    """Mean of the line costs per unit, with totals and the weighted mean to check it by.

    The name is the one on the earliest line, because lines have no file order. Lines are
    summed per item and name first: a text column in the aggregate itself would make it
    sort all lines.
    """
    each = F.col("cogs").cast("double") / F.col("quantity").cast("double")
    by_name = (
        lines.where((F.col("quantity") > 0) & (F.col("cogs") > 0))
        .groupBy("item_code", "item_name")
        .agg(
            F.min("doc_date").alias("first_day"),
            F.sum(each).alias("each"),
            F.count(F.lit(1)).alias("lines"),
            F.sum("quantity").alias("quantity"),
            F.sum("cogs").alias("cogs"),
        )
    )
    quantity, cost = F.sum("quantity"), F.sum("cogs")
    return by_name.groupBy("item_code").agg(
        F.min_by("item_name", F.struct("first_day", "item_name")).alias("product_name"),
        round_half_up(F.sum("each") / F.sum("lines"), 2).alias("avg_cogs_per_unit"),
        quantity.alias("total_quantity"),
        cost.alias("total_cogs"),
        round_half_up(cost.cast("double") / quantity.cast("double"), 4).alias("total_avg_cogs"),
    )
