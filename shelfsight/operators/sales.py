"""Sales lines: detail, summaries, product ranking and launch tracking."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfsight.functions import (
    between_dates,
    growth_rate,
    month_start,
    net_revenue,
    quarter_label,
    upc_norm12,
)
from shelfsight.functions.codes import UNKNOWN_UPC


def transaction_detail(tx: DataFrame, lo, hi) -> DataFrame:
    """One row per sales line of the period. Sort at the sink if an order is wanted."""
    return tx.where(between_dates("posting_date", lo, hi)).select(
        "posting_date",
        F.year("posting_date").alias("year"),
        quarter_label("posting_date").alias("quarter"),
        F.col("description").alias("product_name"),
        F.col("item_code").alias("upc_item_code_raw"),
        upc_norm12("item_code").alias("upc_item_code_norm12"),
        "distributor_item_code",
        "distributor",
        "sales_rep",
        "canonical_code",
        "base_card_code",
        "ship_to_code",
        "quantity",
        net_revenue().alias("revenue"),
        F.col("amount").alias("amount_raw"),
        "transaction_hash",
    )


def normalise_launches(launches: DataFrame) -> DataFrame:
    return launches.select(
        F.col("product_label").alias("sku_name"), upc_norm12("upc_dashed").alias("upc_norm12")
    )


def launch_transactions(tx: DataFrame, launches: DataFrame, lo, hi) -> DataFrame:
    """Detail lines of launched products only.

    No broadcast hint: the planner compares the list's size with
    ``spark.sql.autoBroadcastJoinThreshold`` and falls back to a shuffled semi join.
    """
    wanted = normalise_launches(launches).select(
        F.col("upc_norm12").alias("upc_item_code_norm12")
    )
    return transaction_detail(tx, lo, hi).join(wanted, "upc_item_code_norm12", "left_semi")


def sales_summary(
    tx: DataFrame,
    keys: Sequence[str | Column],
    lo,
    hi,
    revenue: str = "revenue_ytd",
    units: str = "units_ytd",
) -> DataFrame:
    """Revenue, units and line count per key and product."""
    return (
        tx.where(between_dates("posting_date", lo, hi))
        .groupBy(*keys, F.col("description").alias("product_name"))
        .agg(
            F.sum(net_revenue()).alias(revenue),
            F.sum("quantity").alias(units),
            F.count(F.lit(1)).alias("txn_count"),
        )
    )


def monthly_summary(tx: DataFrame, lo, hi) -> DataFrame:
    month = month_start("posting_date").alias("month")
    return sales_summary(tx, [month], lo, hi, revenue="revenue", units="units")


def distributor_summary(tx: DataFrame, lo, hi) -> DataFrame:
    return sales_summary(tx, ["distributor"], lo, hi)


def salesrep_summary(tx: DataFrame, lo, hi) -> DataFrame:
    return sales_summary(tx, ["sales_rep"], lo, hi)


def account_summary(tx: DataFrame, lo, hi) -> DataFrame:
    return sales_summary(tx, ["canonical_code"], lo, hi)


def accounts_topn(tx: DataFrame, lo, hi, n: int = 50) -> DataFrame:
    """The ``n`` accounts with most revenue per product, NULL revenue first.

    The rank filter is pushed below the shuffle as a group limit, so a product that
    holds most of the accounts still sends at most ``n`` rows per input partition.
    """
    by_revenue = Window.partitionBy("product_name").orderBy(
        F.col("revenue_ytd").desc_nulls_first(), F.col("canonical_code").asc_nulls_last()
    )
    return (
        account_summary(tx, lo, hi)
        .withColumn("rank", F.row_number().over(by_revenue))
        .where(F.col("rank") <= n)
    )


def _by_upc_and_name(tx: DataFrame, lo, hi, prior_lo, prior_hi) -> DataFrame:
    """Current and prior sums per (UPC, name): the only shuffle of line volume."""
    current = between_dates("posting_date", lo, hi)
    prior = between_dates("posting_date", prior_lo, prior_hi)
    units = F.coalesce(F.col("quantity"), F.lit(0))
    return (
        tx.where(between_dates("posting_date", prior_lo, hi))
        .groupBy(upc_norm12("item_code").alias("upc_norm12"), "description")
        .agg(
            F.sum(F.when(current, net_revenue())).alias("current_revenue"),
            F.sum(F.when(current, units)).alias("current_units"),
            F.sum(F.when(prior, net_revenue())).alias("prior_revenue"),
            F.count(F.when(current, F.lit(1))).alias("current_lines"),
        )
    )


def _commonest(name: str, lines: str) -> Column:
    """Most frequent name; ties go to the smallest one and NULL comes last."""
    order = F.struct(-F.col(lines), F.col(name).isNull(), F.col(name))
    return F.min_by(F.col(name), order)


def sku_names(tx: DataFrame, lo, hi) -> DataFrame:
    """Most frequent product name per UPC.

    An aggregate rather than a window: the all-zero UPC may hold a large share of all
    names, and only an aggregate is combined before the shuffle.
    """
    return (
        tx.where(between_dates("posting_date", lo, hi))
        .groupBy(upc_norm12("item_code").alias("upc_norm12"), "description")
        .agg(F.count(F.lit(1)).alias("lines"))
        .groupBy("upc_norm12")
        .agg(_commonest("description", "lines").alias("sku_name"), F.max("lines").alias("lines"))
    )


def sku_growth(
    tx: DataFrame, lo, hi, prior_lo, prior_hi, exclude_unknown: bool = False
) -> DataFrame:
    """Revenue, units and growth for every UPC sold in the current period."""
    known = F.col("upc_norm12") != UNKNOWN_UPC if exclude_unknown else F.lit(True)
    return (
        _by_upc_and_name(tx, lo, hi, prior_lo, prior_hi)
        .where(known)
        .groupBy("upc_norm12")
        .agg(
            _commonest("description", "current_lines").alias("sku_name"),
            F.sum("current_revenue").alias("ytd_revenue"),
            F.sum("current_units").alias("ytd_units"),
            F.sum("prior_revenue").alias("prior_revenue"),
            F.sum("current_lines").alias("current_lines"),
        )
        .where(F.col("current_lines") > 0)
        .select(
            F.coalesce("sku_name", "upc_norm12").alias("sku_name"),
            "upc_norm12",
            "ytd_revenue",
            "ytd_units",
            growth_rate(F.col("ytd_revenue"), F.col("prior_revenue")).alias("growth_rate"),
            F.lit(None).cast("double").alias("profit_margin"),
        )
    )


def top_skus_growth(
    tx: DataFrame, lo, hi, prior_lo, prior_hi, n: int = 10, exclude_unknown: bool = False
) -> DataFrame:
    """The ``n`` UPCs with most current revenue; ``hi=None`` leaves the period open."""
    return (
        sku_growth(tx, lo, hi, prior_lo, prior_hi, exclude_unknown)
        .orderBy(F.col("ytd_revenue").desc_nulls_first(), "upc_norm12")
        .limit(n)
    )


def launch_performance(
    tx: DataFrame, launches: DataFrame, lo, hi, prior_lo, prior_hi
) -> DataFrame:
    """Sales of each launched product; launches without sales stay, with zeros.

    The lines are cut down to launched codes by a semi join before the aggregate, so
    the shuffle carries one partial row per launch and input partition.
    """
    listed = normalise_launches(launches)
    current = between_dates("posting_date", lo, hi)
    prior = between_dates("posting_date", prior_lo, prior_hi)
    sold = (
        tx.where(between_dates("posting_date", prior_lo, hi))
        .withColumn("upc_norm12", upc_norm12("item_code"))
        .join(listed.select("upc_norm12"), "upc_norm12", "left_semi")
        .groupBy("upc_norm12")
        .agg(
            F.sum(F.when(current, net_revenue())).alias("current_revenue"),
            F.sum(F.when(current, F.coalesce(F.col("quantity"), F.lit(0)))).alias("current_units"),
            F.sum(F.when(prior, net_revenue())).alias("prior_revenue"),
        )
    )
    revenue = F.coalesce(F.col("current_revenue"), F.lit(0))
    return listed.join(sold, "upc_norm12", "left").select(
        "sku_name",
        "upc_norm12",
        revenue.alias("ytd_revenue"),
        F.coalesce(F.col("current_units"), F.lit(0)).alias("ytd_units"),
        growth_rate(revenue, F.col("prior_revenue")).alias("growth_rate"),
        F.lit(None).cast("double").alias("profit_margin"),
    )
