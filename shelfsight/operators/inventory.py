"""Stock snapshots: month-over-month transitions and last-reorder information."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfsight.functions import month_start
from shelfsight.functions.dates import as_date

# Names of the transition categories, and how many of each the ranking lists (None: all).
CATEGORIES: dict[str, int | None] = {
    "at_risk_reordered": 20,
    "oos_recovered": None,
    "new_at_risk": 10,
    "new_oos": None,
    "persistent_at_risk": 10,
    "persistent_oos": 10,
    "improved": 10,
}


def _item_to_sku(per_item: DataFrame, mapping: DataFrame) -> DataFrame:
    skus = mapping.select("item_code", F.col("part_number").alias("sku"))
    return per_item.join(skus, "item_code")


def orders_by_sku(lines: DataFrame, mapping: DataFrame) -> DataFrame:
    """Units and latest date ordered per SKU and month.

    Lines are summed per item before the lookup, so the join carries one row per item
    and month instead of one per line.
    """
    per_item = lines.groupBy("item_code", month_start("doc_date").alias("month")).agg(
        F.sum("quantity").alias("quantity"), F.max("doc_date").alias("order_date")
    )
    return (
        _item_to_sku(per_item, mapping)
        .groupBy("sku", "month")
        .agg(
            F.sum("quantity").cast("bigint").alias("order_qty"),
            F.max("order_date").alias("order_date"),
        )
    )


def _before(*keys: str) -> list[Column | str]:
    return [
        *keys,
        F.coalesce("at_risk", F.lit(False)).alias("prev_at_risk"),
        F.coalesce("qty_available", F.lit(0)).alias("prev_qty"),
        F.col("weeks_of_supply").alias("prev_weeks_supply"),
    ]


def _after(*keys: str) -> list[Column | str]:
    return [
        *keys,
        "product_name",
        F.coalesce("at_risk", F.lit(False)).alias("still_at_risk"),
        F.coalesce("qty_available", F.lit(0)).alias("curr_qty"),
        F.col("weeks_of_supply").alias("curr_weeks_supply"),
        "velocity_monthly",
        F.coalesce("risk_label", F.lit("Unknown")).alias("risk_label"),
    ]


def inventory_transitions(
    previous: DataFrame, current: DataFrame, orders: DataFrame
) -> DataFrame:
    """Two single months: one row per SKU and category it falls into; the categories overlap.

    SKUs missing on either side are left out.
    """
    both = current.select(*_after("sku")).join(previous.select(*_before("sku")), "sku")
    return _categorised(both, orders, ["sku"])


def monthly_transitions(snapshot: DataFrame, orders: DataFrame) -> DataFrame:
    """The same for every month against the one before, from one pass over the snapshot.

    A SKU has one row per month. Its previous row counts if it is exactly one month back;
    the window holds the months of one SKU.
    """
    by_month = Window.partitionBy("sku").orderBy("month")
    earlier = F.lag(F.struct("month", *_before())).over(by_month)
    both = (
        snapshot.withColumn("__earlier", earlier)
        .where(F.col("__earlier.month") == F.add_months("month", -1))
        .select(*_after("month", "sku"), "__earlier.prev_at_risk", "__earlier.prev_qty",
                "__earlier.prev_weeks_supply")
    )
    return _categorised(both, orders, ["month", "sku"])


def _categorised(both: DataFrame, orders: DataFrame, on: list[str]) -> DataFrame:
    ordered = orders.select(*on, "order_qty", "order_date", F.lit(True).alias("was_ordered"))
    both = both.join(ordered, on, "left").withColumn(
        "was_ordered", F.coalesce("was_ordered", F.lit(False))
    )
    was, still, bought = F.col("prev_at_risk"), F.col("still_at_risk"), F.col("was_ordered")
    had, has = F.col("prev_qty"), F.col("curr_qty")
    rules: dict[str, Column] = {
        "at_risk_reordered": was & bought,
        "oos_recovered": (had == 0) & (has > 0),
        "new_at_risk": ~was & still,
        "new_oos": (had > 0) & (has == 0),
        "persistent_at_risk": was & still & ~bought,
        "persistent_oos": (had == 0) & (has == 0),
        "improved": was & ~still,
    }
    matched = F.array(*(F.when(rule, F.lit(name)) for name, rule in rules.items()))
    return both.select(
        *on,
        F.explode(F.array_compact(matched)).alias("category"),
        "product_name",
        "prev_qty",
        "curr_qty",
        (has - had).alias("qty_change"),
        "prev_weeks_supply",
        "curr_weeks_supply",
        "velocity_monthly",
        "risk_label",
        "was_ordered",
        "order_qty",
        "order_date",
        "still_at_risk",
        F.when(still, F.lit("Still At-Risk")).otherwise(F.lit("Resolved")).alias("status_change"),
    )


def transition_counts(transitions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Number of SKUs per category, as one column each; 0 where a category is empty."""
    return transitions.groupBy(*by).agg(
        *(F.count_if(F.col("category") == name).alias(name) for name in CATEGORIES)
    )


def transition_topn(
    transitions: DataFrame,
    limits: Mapping[str, int | None] | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """The most pressing rows of each category: lowest cover first, reordered ones by risk.

    ``limits`` gives the number of rows per category, None for all of them. All categories
    are ranked in one pass, with the limit pushed below the shuffle. In an unlimited one
    every SKU is a group of its own, so its rows are neither gathered nor ranked.
    """
    limits = dict(CATEGORIES if limits is None else limits)
    longest = max((n for n in limits.values() if n is not None), default=1)
    endless = [name for name, n in limits.items() if n is None]
    reordered = F.col("category") == "at_risk_reordered"
    alone = F.when(F.col("category").isin(endless), F.col("sku"))
    order = Window.partitionBy(*by, "category", alone).orderBy(
        F.when(reordered & ~F.col("still_at_risk"), 1).otherwise(0),
        F.coalesce("curr_weeks_supply", F.lit(0.0)),
        "sku",
    )
    cap = F.coalesce(
        *(F.when(F.col("category") == name, F.lit(n or longest)) for name, n in limits.items()),
        F.lit(0),
    )
    return (
        transitions.where(F.col("category").isin(list(limits)))
        .withColumn("rank", F.row_number().over(order))
        .where((F.col("rank") <= longest) & (F.col("rank") <= cap))
        .withColumn("rank", F.when(~F.col("category").isin(endless), F.col("rank")))
    )


def reorder_tracking(
    snapshot: DataFrame, lines: DataFrame, mapping: DataFrame, as_of: dt.date | str
) -> DataFrame:
    """Every snapshot row with the SKU's latest order up to ``as_of``; NULLs without one.

    Of several lines on the latest day the one with most units counts. The lines are
    reduced to item and day with a plain maximum, which hashes, before the latest day is
    picked and looked up.
    """
    known = lines.where(F.col("doc_date") <= as_date(as_of))
    per_day = known.groupBy("item_code", "doc_date").agg(F.max("quantity").alias("quantity"))
    latest = F.max(F.struct("doc_date", "quantity", "item_code"))
    last = (
        _item_to_sku(per_day.groupBy("item_code").agg(latest.alias("line")), mapping)
        .groupBy("sku")
        .agg(F.max("line").alias("line"))
        .select(
            "sku",
            F.col("line.doc_date").alias("last_order_date"),
            F.col("line.quantity").cast("bigint").alias("last_order_qty"),
            F.col("line.item_code").alias("last_order_item"),
        )
    )
    return snapshot.join(last, "sku", "left").withColumn(
        "days_since_order", F.datediff(as_date(as_of), "last_order_date")
    )


def reorder_recent(tracked: DataFrame, days: int = 60) -> DataFrame:
    """At-risk rows, with a flag for an order within ``days``; an order today counts."""
    recent = F.coalesce(F.col("days_since_order") <= days, F.lit(False))
    return tracked.where("at_risk").withColumn("has_recent_order", recent)


def reorder_attention(tracked: DataFrame, days: int = 60, n: int = 5) -> DataFrame:
    """Per month the ``n`` at-risk SKUs without a recent order that have least cover.

    Unknown or zero cover sorts as 999 weeks.
    """
    cover = F.coalesce(F.nullif("weeks_of_supply", F.lit(0.0)), F.lit(999.0))
    order = Window.partitionBy("month").orderBy(cover, "sku")
    return (
        reorder_recent(tracked, days)
        .where(~F.col("has_recent_order"))
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= n)
    )


def reorder_recent_top(tracked: DataFrame, days: int = 60, n: int = 10) -> DataFrame:
    """Per month the ``n`` at-risk SKUs whose recent order is the latest."""
    order = Window.partitionBy("month").orderBy("days_since_order", "sku")
    return (
        reorder_recent(tracked, days)
        .where("has_recent_order")
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= n)
    )
