"""Out-of-stock periods and the units lost to them.

Both forms work on one row per item and month, so a window over an item never holds more
rows than there are months.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfsight.functions import clean_token, round_half_up
from shelfsight.functions.dates import as_date, month_from_number, month_number

WEEKS_PER_MONTH = "4.33"
DAYS_PER_MONTH = 30
LOOKBACK_MONTHS = 3


def _impact(keys: Sequence[str], start: Column, back: Column, length: Column, volume: Column):
    """The columns both forms report."""
    return [
        *(F.col(k) for k in keys),
        start.alias("oos_start_month"),
        back.alias("back_in_stock_month"),
        length.cast("int").alias("months_oos"),
        F.round(length * F.lit(WEEKS_PER_MONTH).cast("decimal(4,2)"), 1)
        .cast("double")
        .alias("weeks_oos"),
        round_half_up(volume, 2).alias("avg_monthly_volume"),
        round_half_up(volume * length, 2).alias("lost_units"),
        F.when(back.isNull(), F.lit("Still OOS")).otherwise(F.lit("Restocked")).alias("status"),
        F.when(back.isNotNull(), length * DAYS_PER_MONTH)
        .cast("int")
        .alias("recovery_time_days"),
    ]


def oos_from_sales(
    sales: DataFrame,
    first_month: dt.date | str | None,
    last_month: dt.date | str | None,
    keys: Sequence[str] = ("item",),
) -> DataFrame:
    """Runs of months without sales, from rows ``(keys, month, qty)`` unique per month.

    Rows without an item (the first key) are left out.
    Months that have no row count as zero, so nothing is filled in: only months with
    sales are kept, and a run is what lies between a positive month (with the negative
    months that directly follow it) and the next positive one. The volume is the mean of
    the up to three months before the run, and a run without any is dropped.

    ``first_month`` and ``last_month`` bound the history; None, for a table without sales,
    gives no run.
    """
    keys = list(keys)
    if first_month is None or last_month is None:
        first_month = last_month = "1970-01-01"
    origin = month_number(as_date(first_month))
    months = month_number(as_date(last_month)) - origin + 1
    item = Window.partitionBy(*keys)
    along = item.orderBy("i")
    sold = (
        sales.where(
            clean_token(keys[0]).isNotNull()
            & (F.col("qty") != 0)
            & F.col("month").between(as_date(first_month), as_date(last_month))
        )
        .select(*keys, (month_number("month") - origin).alias("i"), "qty")
        .withColumns(
            {
                "stretch": F.sum(F.when(F.col("qty") > 0, 1).otherwise(0)).over(
                    along.rowsBetween(Window.unboundedPreceding, 0)
                ),
                "recent": F.sum("qty").over(along.rangeBetween(1 - LOOKBACK_MONTHS, 0)),
            }
        )
        .where(F.col("stretch") > 0)
    )
    inside = Window.partitionBy(*keys, "stretch").orderBy("i")
    unbroken = F.col("i") - F.first("i").over(inside) == F.row_number().over(inside) - 1
    stretches = (
        sold.withColumn("unbroken", unbroken)
        .groupBy(*keys, "stretch")
        .agg(
            F.min("i").alias("from"),
            F.count_if("unbroken").alias("held"),
            F.max_by("recent", F.when(F.col("unbroken"), F.col("i"))).alias("recent"),
        )
        .withColumn("next", F.lead("from").over(item.orderBy("stretch")))
    )
    start = F.col("from") + F.col("held")
    length = F.coalesce("next", months) - F.col("start")
    volume = F.col("recent").cast("double") / F.least(F.col("start"), F.lit(LOOKBACK_MONTHS))
    back = F.when(F.col("next").isNotNull(), month_from_number(origin + F.col("next")))
    return (
        stretches.withColumn("start", start)
        .where((length > 0) & (F.col("recent") > 0))
        .select(
            *_impact(keys, month_from_number(origin + F.col("start")), back, length, volume)
        )
    )


def month_positions(snapshot: DataFrame) -> DataFrame:
    """Place of each month among the months that occur, and how many there are.

    At most twelve rows per calendar year, which is why the unpartitioned window is safe.
    """
    return (
        snapshot.select("month")
        .where(F.col("month").isNotNull())
        .distinct()
        .select(
            "month",
            (F.row_number().over(Window.orderBy("month")) - 1).alias("i"),
            F.count(F.lit(1)).over(Window.partitionBy()).cast("int").alias("n_months"),
        )
    )


def oos_from_snapshots(snapshot: DataFrame, months: DataFrame | None = None) -> DataFrame:
    """Runs of months with zero stock, from snapshot rows unique per SKU and month.

    ``months`` is the result of ``month_positions`` if the caller can list the months from
    something cheaper than the snapshot, which else is read twice.

    Zero opens a run, positive stock closes it, negative stock changes nothing. A month
    the SKU has no row for is skipped but counts in the length. The volume is the mean of
    the positive velocities of the up to three month positions before the run.
    """
    item = Window.partitionBy("sku").orderBy("i")
    placed = snapshot.select(
        "sku", "product_name", "month", "qty_available", "velocity_monthly"
    ).join(month_positions(snapshot) if months is None else months, "month")
    stock = F.col("qty_available")
    moving = F.when(F.col("velocity_monthly") > 0, F.col("velocity_monthly"))
    known = F.when(stock == 0, 1).when(stock > 0, 0)
    state = F.last(known, ignorenulls=True).over(item.rowsBetween(Window.unboundedPreceding, 0))
    marked = (
        placed.withColumns(
            {
                "out": F.coalesce(state, F.lit(0)),
                "volume": F.avg(moving).over(item.rangeBetween(-LOOKBACK_MONTHS, -1)),
            }
        )
        .withColumn("opens", (F.col("out") == 1) & (F.lag("out", 1, 0).over(item) == 0))
        .withColumns(
            {
                "run": F.count_if("opens").over(item.rowsBetween(Window.unboundedPreceding, 0)),
                "name": F.first("product_name").over(
                    item.rowsBetween(Window.unboundedPreceding, 0)
                ),
            }
        )
        .where(F.col("run") > 0)
    )
    closes = F.col("out") == 0
    runs = marked.groupBy("sku", F.col("name").alias("product_name"), "run").agg(
        F.min("i").alias("start"),
        F.min("month").alias("start_month"),
        F.min(F.when(closes, F.col("i"))).alias("back"),
        F.min(F.when(closes, F.col("month"))).alias("back_month"),
        F.max(F.when(F.col("opens"), F.col("volume"))).alias("volume"),
        F.max("n_months").alias("n_months"),
    )
    length = F.coalesce("back", "n_months") - F.col("start")
    return runs.where(F.col("volume").isNotNull()).select(
        *_impact(
            ["sku", "product_name"],
            F.col("start_month"),
            F.col("back_month"),
            length,
            F.col("volume"),
        )
    )


def oos_summary(runs: DataFrame) -> DataFrame:
    still = F.count_if(F.col("status") == "Still OOS")
    return runs.agg(
        F.count(F.lit(1)).alias("total_oos_periods"),
        still.alias("still_oos_count"),
        (F.count(F.lit(1)) - still).alias("restocked_count"),
        F.coalesce(
            F.sum(F.col("lost_units").cast("decimal(28,2)")).cast("double"), F.lit(0.0)
        ).alias("total_lost_units"),
    )


def oos_top(runs: DataFrame, n: int = 10, key: str = "item") -> DataFrame:
    return runs.orderBy(F.col("lost_units").desc(), key, "oos_start_month").limit(n)
