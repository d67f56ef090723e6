"""Monthly revenue series per key and their projection."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfsight.functions import month_start
from shelfsight.functions.dates import as_date, month_from_number, month_number

# Ways to cut revenue into series.
GROUPS: dict[str, tuple[str, ...]] = {
    "product_distributor": ("product_name", "distributor"),
    "product": ("product_name",),
    "distributor": ("distributor",),
    "rep": ("sales_rep",),
    "product_rep": ("product_name", "sales_rep"),
}
ALL_DISTRIBUTORS = "ALL"
MIN_MONTHS = 3
STEPS = 12
SEASON = 12
BAND = 1.96  # half width of a 95 % band in standard deviations
MODEL = "trend_seasonal"


def monthly_by_key(
    lines: DataFrame,
    group: str,
    paid_only: bool = False,
    day: str = "posting_date",
    revenue: str = "revenue",
) -> DataFrame:
    """Revenue per key and month. Lines without a date are left out, NULL keys are kept."""
    rows = lines.where(F.col(day).isNotNull())
    if paid_only:
        rows = rows.where(F.col(revenue) > 0)
    return rows.groupBy(*GROUPS[group], month_start(day).alias("month")).agg(
        F.sum(F.coalesce(revenue, F.lit(0))).alias("revenue")
    )


def monthly_gapfill(monthly: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every month between a key's first and last one, 0 where it had no sales.

    Each row fills the months up to the key's next row itself, so nothing is joined.
    """
    following = F.lead("month").over(Window.partitionBy(*keys).orderBy("month"))
    last = F.coalesce(F.add_months("next_month", -1), F.col("month"))
    span = F.sequence("month", last, F.expr("INTERVAL 1 MONTH"))
    return (
        monthly.withColumn("next_month", following)
        .select(*keys, "revenue", F.posexplode(span).alias("step", "filled"))
        .select(
            *keys,
            F.col("filled").alias("month"),
            F.when(F.col("step") == 0, F.col("revenue")).otherwise(F.lit(0)).alias("revenue"),
        )
    )


def _rolled_up(monthly: DataFrame) -> DataFrame:
    """Revenue per product and month over all distributors, for forecastable products."""
    product = Window.partitionBy("product_name")
    return (
        monthly.where(F.col("product_name").isNotNull())
        .groupBy("product_name", "month")
        .agg(F.sum("revenue").alias("revenue"))
        .withColumn("positive", F.count_if(F.col("revenue") > 0).over(product))
    )


def forecast_series_routing(monthly: DataFrame, min_months: int = MIN_MONTHS) -> DataFrame:
    """How each product and distributor pair is forecast.

    ``direct`` with enough positive months; else ``rollup`` if the product has enough
    over all distributors; else ``skip``.
    """
    pairs = monthly.groupBy("product_name", "distributor").agg(
        F.count_if(F.col("revenue") > 0).alias("positive_months")
    )
    products = (
        _rolled_up(monthly)
        .groupBy("product_name")
        .agg(F.max("positive").alias("product_positive_months"))
    )
    route = (
        F.when(F.col("positive_months") >= min_months, F.lit("direct"))
        .when(F.col("product_positive_months") >= min_months, F.lit("rollup"))
        .otherwise(F.lit("skip"))
    )
    # pairs without a product match nothing; they spread by distributor
    known = F.col("product_name").isNotNull()
    keyed = pairs.withColumns(
        {"__key": F.coalesce("product_name", "distributor"), "__known": known}
    )
    by_key = products.select(
        F.col("product_name").alias("__key"), F.lit(True).alias("__known"), "product_positive_months"
    )
    return (
        keyed.join(by_key, ["__key", "__known"], "left")
        .drop("__key", "__known")
        .withColumn("route", route)
    )


def routed_series(monthly: DataFrame, min_months: int = MIN_MONTHS) -> DataFrame:
    """The series to forecast: dense pairs, and one roll-up per product with a sparse pair."""
    pair = Window.partitionBy("product_name", "distributor")
    positive = F.count_if(F.col("revenue") > 0).over(pair)
    direct = monthly.withColumn("positive", positive).where(F.col("positive") >= min_months)
    sparse = (
        monthly.groupBy("product_name", "distributor")
        .agg(F.count_if(F.col("revenue") > 0).alias("positive"))
        .where(F.col("positive") < min_months)
        .select("product_name")
    )
    rolled = (
        _rolled_up(monthly)
        .where(F.col("positive") >= min_months)
        .join(sparse, "product_name", "left_semi")
        .withColumn("distributor", F.lit(ALL_DISTRIBUTORS))
    )
    columns = ["product_name", "distributor", "month", "revenue"]
    return direct.select(columns).unionByName(rolled.select(columns))


def key_label(group: str) -> Column:
    """Text that names a series: the product or partner, or both."""
    first, *second = (F.coalesce(F.col(c), F.lit("")) for c in GROUPS[group])
    if not second:
        return first
    joint = " | rep:" if group == "product_rep" else " | "
    return F.concat(first, F.lit(joint), second[0])


def _project(monthly: DataFrame, keys: Sequence[str], steps: int) -> DataFrame:
    """Trend plus month-of-year effect per key; months without sales between count as 0.

    One aggregate per key holds its sums and its points, at most one per month; the months
    without sales only enter closed forms and the array of residuals, so no rows are filled
    in and nothing is put in order.
    """
    number, y = month_number("month"), F.col("revenue")
    point = F.struct(number.alias("i"), y.cast("double").alias("y"))
    per_key = (
        monthly.groupBy(*keys)
        .agg(
            F.min(number).alias("lo"),
            F.max(number).alias("hi"),
            F.sum(y).cast("double").alias("sy"),
            F.sum(number * y).alias("siy"),
            F.sum(y).alias("total"),
            F.collect_list(point).alias("points"),
        )
        .where(F.col("hi") > F.col("lo"))
    )
    n = (F.col("hi") - F.col("lo") + 1).cast("double")
    st, stt = n * (n - 1) / 2, n * (n - 1) * (2 * n - 1) / 6
    sty = (F.col("siy") - F.col("lo") * F.col("total")).cast("double")
    slope = (n * sty - st * F.col("sy")) / (n * stt - st * st)
    fitted = (
        per_key.withColumn("n", n)
        .withColumn("slope", slope)
        .withColumn("intercept", (F.col("sy") - F.col("slope") * st) / n)
    )

    def effect(m: Column) -> Column:
        # steps t0, t0 + 12, ... of the series fall into month-of-year m (0 to 11)
        t0 = F.pmod(m - F.col("lo"), F.lit(SEASON))
        count = F.floor((F.col("n") - 1 - t0) / SEASON) + 1
        steps_sum = count * t0 + SEASON * count * (count - 1) / 2
        own = F.filter("points", lambda p: F.pmod(p["i"], F.lit(SEASON)) == m)
        total = F.aggregate(own, F.lit(0.0), lambda acc, p: acc + p["y"])
        line = F.col("intercept") * count + F.col("slope") * steps_sum
        return F.when(F.col("n") >= 2 * SEASON, (total - line) / count).otherwise(F.lit(0.0))

    def residual(i: Column) -> Column:
        line = F.col("intercept") + F.col("slope") * (i - F.col("lo"))
        seasonal = F.get("effects", F.pmod(i, F.lit(SEASON)))
        return F.coalesce(F.try_element_at("by_month", i), F.lit(0.0)) - line - seasonal

    spread = (
        fitted.withColumns(
            {
                "effects": F.transform(F.sequence(F.lit(0), F.lit(SEASON - 1)), effect),
                "by_month": F.map_from_entries("points"),
            }
        )
        .withColumn("residuals", F.transform(F.sequence("lo", "hi"), residual))
        .withColumn(
            "mean", F.aggregate("residuals", F.lit(0.0), lambda acc, r: acc + r) / F.col("n")
        )
    )
    squares = F.aggregate(
        "residuals",
        F.lit(0.0),
        lambda acc, r: acc + (r - F.col("mean")) * (r - F.col("mean")),
    )
    ahead = (
        spread.withColumn("sigma", F.sqrt(squares / (F.col("n") - 1)))
        .select(*keys, "hi", "n", "slope", "intercept", "sigma", "effects",
                F.explode(F.sequence(F.lit(1), F.lit(steps))).alias("h"))
    )
    coming = F.col("hi") + F.col("h")
    yhat = (
        F.col("intercept")
        + F.col("slope") * (F.col("n") - 1 + F.col("h"))
        + F.get("effects", F.pmod(coming, F.lit(SEASON)))
    )
    return ahead.withColumn("yhat", yhat).select(
        *keys,
        month_from_number(coming).alias("date"),
        "yhat",
        (F.col("yhat") - F.lit(BAND) * F.col("sigma")).alias("yhat_lower"),
        (F.col("yhat") + F.lit(BAND) * F.col("sigma")).alias("yhat_upper"),
        F.lit(MODEL).alias("model"),
    )


def sales_forecast(
    monthly: DataFrame,
    group: str,
    steps: int = STEPS,
    cutoff: dt.date | str | None = None,
    min_months: int = MIN_MONTHS,
) -> DataFrame:
    """Point forecast with a 95 % band for the ``steps`` months after each key's last one.

    Series of one month cannot be fitted and are left out.
    """
    keys = GROUPS[group]
    series = routed_series(monthly, min_months) if group == "product_distributor" else monthly
    forecast = _project(series, keys, steps)
    if cutoff is not None:
        forecast = forecast.where(F.col("date") <= as_date(cutoff))
    return forecast.select(
        "*", F.lit(group).alias("key_type"), key_label(group).alias("key_id")
    )
