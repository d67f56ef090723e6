"""Forecast against actual sales, per item and month."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfsight.functions import clean_token, month_start, round_half_up, variance_metrics
from shelfsight.operators.ranking import running_totals
from shelfsight.operators.staging import stage


def sku_mapping(catalog: DataFrame, key: str, value: str, line_no: str = "line_no") -> DataFrame:
    """Lookup ``key -> value`` of a catalog; the last listed line of a key wins."""
    return (
        catalog.select(
            clean_token(key).alias("key"), clean_token(value).alias("value"), F.col(line_no)
        )
        .where(F.col("key").isNotNull() & F.col("value").isNotNull())
        .groupBy(F.col("key").alias(key))
        .agg(F.max_by("value", line_no).alias(value))
    )


def month_columns(columns: Sequence[str]) -> dict[str, dt.date]:
    """The ``YYYY-MM`` headers of a wide table and the months they stand for."""
    found = {}
    for name in columns:
        match = re.fullmatch(r"(\d{4})-(\d{2})", name.strip())
        if match:
            found[name] = dt.date(int(match[1]), int(match[2]), 1)
    return found


def january_column(columns: Sequence[str], year: int) -> str | None:
    """Header that holds January: a date in January, else text such as ``25-Jan``."""
    for name in columns:
        match = re.match(r"\d{4}-(\d{2})-\d{2}", name)
        if match and match[1] == "01":
            return name
    short = f"{year % 100:02d}"
    marks = ("jan", f"01-{short}", f"{short}-01")
    return next((c for c in columns if any(m in c.lower() for m in marks)), None)


def forecast_unpivot(
    wide: DataFrame, months: Mapping[str, dt.date] | None = None, value: str = "forecast_qty"
) -> DataFrame:
    """Wide month columns to rows ``(…, month, value)``; NULL cells are kept."""
    months = dict(months or month_columns(wide.columns))
    if not months:
        raise ValueError("no month columns found")
    ids = [c for c in wide.columns if c not in months]
    dates = F.create_map(
        *(part for name, day in months.items() for part in (F.lit(name), F.lit(day)))
    )
    quoted = [F.col(f"`{name}`") for name in months]
    return (
        wide.select(*ids, *(c.cast("double").alias(n) for c, n in zip(quoted, months)))
        .unpivot(ids, quoted, "__label", value)
        .select(*ids, dates[F.col("__label")].alias("month"), value)
    )


def forecast_item_resolve(
    forecast: DataFrame, mapping: DataFrame, part: str = "part_number", item: str = "item"
) -> DataFrame:
    """Item of each forecast line: its own, else the catalog's. Unresolved lines stay, flagged.

    Lines without a part number cannot match; they spread by their other columns.
    """
    found = mapping.select(
        F.col(part).alias("__part"),
        F.lit(0).cast("bigint").alias("__spread"),
        F.col(mapping.columns[-1]).alias("__item"),
    )
    own = clean_token(item) if item in forecast.columns else F.lit(None).cast("string")
    resolved = F.coalesce(own, F.col("__item"))
    rest = [c for c in forecast.columns if c not in (item, part)]
    cleaned = clean_token(part)
    spread = F.when(cleaned.isNotNull(), F.lit(0)).otherwise(F.xxhash64(*rest))
    keyed = forecast.withColumns(
        {"__key": F.coalesce(cleaned, F.lit("")), "__other": spread.cast("bigint")}
    )
    match = (F.col("__key") == F.col("__part")) & (F.col("__other") == F.col("__spread"))
    return keyed.join(found, match, "left").select(
        clean_token(part).alias(part),
        resolved.alias(item),
        resolved.isNotNull().alias("item_resolved"),
        *rest,
    )


def monthly_actuals(lines: DataFrame) -> DataFrame:
    return lines.groupBy(
        F.col("item_code").alias("item"), month_start("doc_date").alias("month")
    ).agg(F.sum("quantity").alias("actual_qty"), F.sum("line_total").alias("actual_revenue"))


def _with_actuals(forecast: DataFrame, actuals: DataFrame, zero_forecast: str) -> DataFrame:
    """Left join of the actuals, missing ones as 0, plus the variance columns.

    Lines without an item cannot match. They get their own key instead of NULL, so that
    many of them spread over the partitions of the join.
    """
    known = F.col("item").isNotNull()
    spread = F.when(known, F.col("item")).otherwise(F.col("part_number"))
    left = forecast.withColumn("__key", spread).withColumn("__known", known)
    right = actuals.select(
        F.col("item").alias("__key"),
        "month",
        F.col("actual_qty").cast("double").alias("__qty"),
        F.col("actual_revenue").cast("double").alias("__revenue"),
        F.lit(True).alias("__known"),
    )
    joined = left.join(right, ["__key", "__known", "month"], "left").withColumns(
        {
            "actual_qty": F.coalesce("__qty", F.lit(0.0)),
            "actual_revenue": F.coalesce("__revenue", F.lit(0.0)),
        }
    )
    metrics = variance_metrics(F.col("forecast_qty"), F.col("actual_qty"), zero_forecast)
    return joined.select(
        *forecast.columns,
        "actual_qty",
        "actual_revenue",
        *(column.alias(name) for name, column in metrics.items()),
    )


def forecast_vs_actual(
    forecast: DataFrame, actuals: DataFrame, keep: str = "forecast"
) -> DataFrame:
    """Actuals and variance for every forecast line, all months in one join.

    ``keep="forecast"`` drops lines without a positive forecast. ``keep="any"`` reads a
    missing forecast as 0 and keeps the line if anything was forecast or sold.
    """
    if keep == "forecast":
        return _with_actuals(forecast.where(F.col("forecast_qty") > 0), actuals, "null")
    if keep != "any":
        raise ValueError(f"keep must be 'forecast' or 'any', not {keep!r}")
    filled = forecast.withColumn("forecast_qty", F.coalesce("forecast_qty", F.lit(0.0)))
    joined = _with_actuals(filled, actuals, "zero")
    return joined.where((F.col("forecast_qty") > 0) | (F.col("actual_qty") > 0))


def fva_refresh(fva: DataFrame, actuals: DataFrame) -> DataFrame:
    """Replace the actuals by new ones and derive the variance columns again."""
    derived = ("actual_qty", "actual_revenue", "variance", "variance_pct", "accuracy")
    return _with_actuals(fva.drop(*derived), actuals, "null")


def fva_month_summary(fva: DataFrame) -> DataFrame:
    """Totals per month. Both counts of compared products are given: sold, and sold as forecast."""
    forecast, actual = F.col("total_units_planned"), F.col("month_total_actual")
    metrics = variance_metrics(forecast, actual, "zero")
    sold = F.col("actual_qty") > 0
    return (
        fva.groupBy("month")
        .agg(
            F.sum("forecast_qty").alias("total_units_planned"),
            F.sum("actual_qty").alias("month_total_actual"),
            F.sum(F.col("actual_revenue").cast("decimal(28,2)")).cast("double").alias(
                "total_revenue"
            ),
            F.count(F.lit(1)).alias("qty_products"),
            F.count_if(sold).alias("qty_products_with_sales"),
            F.count_if(sold & (F.col("forecast_qty") > 0)).alias("products_compared"),
        )
        .select(
            "month",
            round_half_up(forecast, 2).alias("total_units_planned"),
            round_half_up(actual, 2).alias("month_total_actual"),
            metrics["accuracy"].alias("month_accuracy"),
            "total_revenue",
            round_half_up(metrics["variance"], 2).alias("total_variance"),
            metrics["variance_pct"].alias("total_variance_pct"),
            "qty_products",
            "qty_products_with_sales",
            "products_compared",
        )
    )


def fva_dashboard_month(
    fva: DataFrame, upcs: DataFrame, distributor: str, page_size: int = 1_000
) -> DataFrame:
    """Month documents: totals plus the products in falling order of forecast.

    A month is cut into pages of ``page_size`` products, so that no single row or task
    holds a whole month however many products it has; a small month is one page. ``fva`` is
    written out once, since order and totals both read it, and the order is fixed by a job
    (see ``running_totals``).
    """
    fva = stage(fva)
    codes = upcs.select(F.col("item_code").alias("item"), F.col("upc_code").alias("upc"))
    known = F.col("item").isNotNull()
    # item_code NULL never matches; spread such lines as in the actuals join
    keyed = fva.withColumn("__key", F.coalesce("item", "part_number")).withColumn("__known", known)
    labelled = keyed.join(
        codes.select(F.col("item").alias("__key"), "upc", F.lit(True).alias("__known")),
        ["__key", "__known"],
        "left",
    ).drop("__key", "__known")
    order = [
        F.col("forecast_qty").desc_nulls_last(),
        F.col("item").asc_nulls_last(),
        F.col("part_number").asc_nulls_last(),
    ]
    placed = running_totals(labelled, order, {"position": F.lit(1)}, by=["month"])
    product = F.struct(
        F.col("position"),
        F.coalesce("description", F.lit("Unknown")).alias("product_name"),
        F.coalesce("item", F.lit("")).alias("item"),
        F.coalesce("upc", F.lit("")).alias("upc"),
        F.lit(distributor).alias("distributor"),
        F.col("forecast_qty").alias("units_planned"),
        F.col("actual_qty").alias("units_actual"),
        F.col("actual_revenue").alias("actual_revenue"),
        F.col("variance").alias("variance"),
        F.coalesce("variance_pct", F.lit(0.0)).alias("variance_pct"),
        F.coalesce("accuracy", F.lit(0.0)).alias("accuracy"),
    )
    page = F.floor((F.col("position") - 1) / page_size).cast("int") + 1
    pages = placed.groupBy("month", page.alias("page")).agg(
        F.sort_array(F.collect_list(product)).alias("products")
    )
    totals = fva_month_summary(fva).withColumnRenamed("month", "__month")
    return (
        pages.join(totals, F.col("month").eqNullSafe(F.col("__month")))
        .drop("__month")
        .withColumn("month_name", month_name("month"))
    )


def month_name(month: Column | str, with_year: bool = False) -> Column:
    """``October`` or, with the year, ``October 2025``."""
    return F.date_format(month, "MMMM yyyy" if with_year else "MMMM")


def dashboard_products(documents: DataFrame, *totals: str) -> DataFrame:
    """The products of month documents as rows again, with some of the document's totals."""
    return documents.select("month", "page", *totals, F.inline("products"))


def month_upsert(old: DataFrame, new: DataFrame, key: str = "month") -> DataFrame:
    """Rows of ``new`` plus the rows of ``old`` for months that ``new`` lacks.

    Rows of ``old`` without a month stay.
    """
    months = new.select(key).where(F.col(key).isNotNull()).distinct()
    return old.join(months, key, "left_anti").unionByName(new, allowMissingColumns=True)


def fva_top_matched(fva: DataFrame, month: dt.date | str | None = None, n: int = 10) -> DataFrame:
    """The ``n`` best sold products per month (or of one month) among those forecast and sold."""
    matched = fva.where((F.col("forecast_qty") > 0) & (F.col("actual_qty") > 0))
    if month is not None:
        matched = matched.where(F.col("month") == F.lit(str(month)).cast("date"))
    best = Window.partitionBy("month").orderBy(
        F.col("actual_qty").desc(),
        F.col("item").asc_nulls_last(),
        F.col("part_number").asc_nulls_last(),
    )
    return matched.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= n)


def forecast_extremes(
    forecast: DataFrame, ties: Sequence[str], n_top: int = 20, n_bottom: int = 10
) -> DataFrame:
    """Largest and smallest positive forecasts; ``ties`` names the columns that break ties."""

    def end(name: str, first: Column, n: int, descending_ties: bool) -> DataFrame:
        rest: list[Column] = [F.col(c).desc() if descending_ties else F.col(c).asc() for c in ties]
        return (
            forecast.where(F.col("forecast_qty") > 0)
            .orderBy(first, *rest)
            .limit(n)
            .withColumn("which", F.lit(name))
        )

    quantity = F.col("forecast_qty")
    return end("top", quantity.desc(), n_top, False).unionByName(
        end("bottom", quantity.asc(), n_bottom, True)
    )
