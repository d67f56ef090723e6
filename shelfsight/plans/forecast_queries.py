"""Forecast against actual, month documents, catalog lookups, unit costs and coercion."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfsight.functions import upc_from_number
from shelfsight.operators import costs
from shelfsight.operators import forecast_actual as fa
from shelfsight.plans.inputs import (
    CATALOG_SQL,
    FORECAST_MONTHS,
    FORECAST_WIDE_SQL,
    INVOICE_LINES_SQL,
    read,
    with_tables,
)
from shelfsight.plans.registry import query
from shelfsight.operators.staging import new_path
from shelfsight.sources.readers import csv_coerced_scan as csv_scan

_INPUTS = dict(catalog=CATALOG_SQL, wide=FORECAST_WIDE_SQL, lines=INVOICE_LINES_SQL)


def _clean(x: str) -> str:
    return f"CASE WHEN trim({x}) NOT IN ('', 'nan') THEN trim({x}) END"


def _mapping_sql(key: str, value: str) -> str:
    return f"""SELECT k AS {key}, v AS {value} FROM (
        SELECT k, v, row_number() OVER (PARTITION BY k ORDER BY line_no DESC) AS rn
        FROM (SELECT {_clean(key)} AS k, {_clean(value)} AS v, line_no FROM catalog) c
        WHERE k IS NOT NULL AND v IS NOT NULL) r WHERE rn = 1"""


_LONG = "long AS (" + " UNION ALL ".join(
    f"SELECT part_number, item AS own, description, DATE '{m}-01' AS month,"
    f' "{m}" AS forecast_qty FROM wide'
    for m in FORECAST_MONTHS
) + ")"
_PARTS = f"parts AS ({_mapping_sql('part_number', 'item_code')})"
_RESOLVED = f"""resolved AS (
  SELECT l.part_number, coalesce({_clean('own')}, m.item_code) AS item,
    coalesce({_clean('own')}, m.item_code) IS NOT NULL AS item_resolved,
    description, month, forecast_qty
  FROM long l LEFT JOIN parts m ON m.part_number = l.part_number)"""
_ACTUALS = """actuals AS (
  SELECT item_code AS item, CAST(date_trunc('month', doc_date) AS DATE) AS month,
    sum(quantity) AS q, sum(line_total) AS r FROM lines GROUP BY 1, 2)"""


def _round(x: str, places: int = 2) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(28,8)), {places}) AS DOUBLE)"


def _metrics(f: str, a: str, zero: str) -> str:
    return f"""{a} - {f} AS variance,
      CASE WHEN {f} > 0 THEN {_round(f'({a} - {f}) / {f} * 100')} ELSE {zero} END AS variance_pct,
      CASE WHEN {f} > 0 THEN {_round(f'least({a} / {f} * 100, 100)')} ELSE {zero} END AS accuracy"""


def _fva(name: str, forecast: str, zero: str, having: str, actuals: str = "actuals") -> str:
    return f"""{name} AS (
  SELECT part_number, item, item_resolved, description, month, forecast_qty, actual_qty,
    actual_revenue, {_metrics('forecast_qty', 'actual_qty', zero)}
  FROM (SELECT s.part_number, s.item, s.item_resolved, s.description, s.month,
      {forecast} AS forecast_qty, CAST(coalesce(a.q, 0) AS DOUBLE) AS actual_qty,
      CAST(coalesce(a.r, 0) AS DOUBLE) AS actual_revenue
    FROM resolved s LEFT JOIN {actuals} a ON a.item = s.item AND a.month = s.month) j
  WHERE {having})"""


_FVA = _fva("fva", "forecast_qty", "NULL", "forecast_qty > 0")
_FVA_ANY = _fva(
    "fva", "coalesce(forecast_qty, 0)", "0", "forecast_qty > 0 OR actual_qty > 0"
)
_BASE = (_LONG, _PARTS, _RESOLVED, _ACTUALS)


def _forecast(spark, sf):
    mapping = fa.sku_mapping(read(spark, sf, CATALOG_SQL), "part_number", "item_code")
    return fa.forecast_item_resolve(
        fa.forecast_unpivot(read(spark, sf, FORECAST_WIDE_SQL)), mapping
    )


def _actuals(spark, sf):
    return fa.monthly_actuals(read(spark, sf, INVOICE_LINES_SQL))


def _fva_df(spark, sf, keep="forecast"):
    return fa.forecast_vs_actual(_forecast(spark, sf), _actuals(spark, sf), keep)


@query("sku_mapping", with_tables(_mapping_sql("item_code", "part_number"), catalog=CATALOG_SQL))
def sku_mapping(spark, sf):
    return fa.sku_mapping(read(spark, sf, CATALOG_SQL), "item_code", "part_number")


@query(
    "forecast_unpivot",
    with_tables(
        "SELECT part_number, own AS item, description, month, forecast_qty FROM long",
        _LONG,
        wide=FORECAST_WIDE_SQL,
    ),
)
def forecast_unpivot(spark, sf):
    return fa.forecast_unpivot(read(spark, sf, FORECAST_WIDE_SQL))


@query(
    "forecast_item_resolve",
    with_tables("SELECT * FROM resolved", _LONG, _PARTS, _RESOLVED, catalog=CATALOG_SQL,
                wide=FORECAST_WIDE_SQL),
)
def forecast_item_resolve(spark, sf):
    return _forecast(spark, sf)


@query(
    "monthly_actuals",
    with_tables(
        "SELECT item, month, CAST(q AS DOUBLE) AS actual_qty, CAST(r AS DOUBLE) AS actual_revenue"
        " FROM actuals",
        _ACTUALS,
        lines=INVOICE_LINES_SQL,
    ),
)
def monthly_actuals(spark, sf):
    return _actuals(spark, sf)


@query("forecast_vs_actual", with_tables("SELECT * FROM fva", *_BASE, _FVA, **_INPUTS))
def forecast_vs_actual(spark, sf):
    return _fva_df(spark, sf)


@query("forecast_vs_actual_any", with_tables("SELECT * FROM fva", *_BASE, _FVA_ANY, **_INPUTS))
def forecast_vs_actual_any(spark, sf):
    return _fva_df(spark, sf, "any")


# the refresh counts only what was paid for
_PAID = """paid AS (
  SELECT item_code AS item, CAST(date_trunc('month', doc_date) AS DATE) AS month,
    sum(quantity) AS q, sum(line_total) AS r FROM lines WHERE cogs > 0 GROUP BY 1, 2)"""
_REFRESHED = _fva("refreshed", "forecast_qty", "NULL", "forecast_qty > 0", "paid")


def _refreshed(spark, sf):
    paid = read(spark, sf, INVOICE_LINES_SQL).where(F.col("cogs") > 0)
    return fa.fva_refresh(_fva_df(spark, sf), fa.monthly_actuals(paid))


@query(
    "fva_refresh",
    with_tables("SELECT * FROM refreshed", *_BASE, _PAID, _REFRESHED, **_INPUTS),
)
def fva_refresh(spark, sf):
    return _refreshed(spark, sf)


def _month_sql(source: str) -> str:
    return f"""SELECT month, {_round('f')} AS total_units_planned,
      {_round('a')} AS month_total_actual,
      CASE WHEN f > 0 THEN {_round('least(a / f * 100, 100)')} ELSE 0 END AS month_accuracy,
      CAST(r AS DOUBLE) AS total_revenue, {_round('a - f')} AS total_variance,
      CASE WHEN f > 0 THEN {_round('(a - f) / f * 100')} ELSE 0 END AS total_variance_pct,
      n AS qty_products, sold AS qty_products_with_sales, matched AS products_compared
    FROM (SELECT month, sum(forecast_qty) AS f, sum(actual_qty) AS a,
        sum(CAST(actual_revenue AS DECIMAL(28,2))) AS r, count(*) AS n,
        count(*) FILTER (WHERE actual_qty > 0) AS sold,
        count(*) FILTER (WHERE actual_qty > 0 AND forecast_qty > 0) AS matched
      FROM {source} GROUP BY month) g"""


@query(
    "fva_month_summary", with_tables(_month_sql("fva"), *_BASE, _FVA_ANY, **_INPUTS)
)
def fva_month_summary(spark, sf):
    return fa.fva_month_summary(_fva_df(spark, sf, "any"))


@query(
    "month_upsert",
    with_tables(
        "SELECT * FROM older WHERE month < DATE '2000-07-01' UNION ALL SELECT * FROM newer",
        *_BASE,
        _FVA,
        _PAID,
        _REFRESHED,
        f"older AS ({_month_sql('fva')})",
        f"newer AS ({_month_sql('refreshed')} WHERE month >= DATE '2000-07-01')",
        **_INPUTS,
    ),
)
def month_upsert(spark, sf):
    older = fa.fva_month_summary(_fva_df(spark, sf))
    newer = fa.fva_month_summary(_refreshed(spark, sf)).where("month >= DATE '2000-07-01'")
    return fa.month_upsert(older, newer)


_PAGE = 250


@query(
    "fva_dashboard_month",
    with_tables(
        f"""SELECT p.month, CAST((position - 1) // {_PAGE} + 1 AS INTEGER) AS page, position,
          monthname(p.month) AS month_name, strftime(p.month, '%B %Y') AS month_title,
          s.total_units_planned, s.month_total_actual, s.month_accuracy, s.total_revenue, s.qty_products,
          coalesce(description, 'Unknown') AS product_name, coalesce(item, '') AS item,
          coalesce(upc, '') AS upc, 'online' AS distributor, forecast_qty AS units_planned,
          actual_qty AS units_actual, actual_revenue, variance, variance_pct, accuracy
        FROM (SELECT f.*, u.upc, row_number() OVER (PARTITION BY month
            ORDER BY forecast_qty DESC NULLS LAST, item ASC NULLS LAST,
              f.part_number ASC NULLS LAST) AS position
          FROM fva f LEFT JOIN (SELECT item_code,
              CASE WHEN length(n) < 12 THEN lpad(n, 12, '0') ELSE n END AS upc
            FROM (SELECT item_code, CAST(CAST(TRY_CAST(upc_code AS DOUBLE) AS BIGINT) AS VARCHAR) AS n
              FROM upcs) x) u ON u.item_code = f.item) p
        JOIN totals s ON s.month IS NOT DISTINCT FROM p.month""",
        *_BASE,
        _FVA_ANY,
        f"totals AS ({_month_sql('fva')})",
        f"upcs AS ({_mapping_sql('item_code', 'upc_code')})",
        **_INPUTS,
    ),
)
def fva_dashboard_month(spark, sf):
    upcs = fa.sku_mapping(read(spark, sf, CATALOG_SQL), "item_code", "upc_code").withColumn(
        "upc_code", upc_from_number("upc_code")
    )
    documents = fa.fva_dashboard_month(_fva_df(spark, sf, "any"), upcs, "online", _PAGE)
    return fa.dashboard_products(
        documents.withColumn("month_title", fa.month_name("month", with_year=True)),
        "month_name",
        "month_title",
        "total_units_planned",
        "month_total_actual",
        "month_accuracy",
        "total_revenue",
        "qty_products",
    )


@query(
    "fva_top_matched",
    with_tables(
        """SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY month
            ORDER BY actual_qty DESC, item ASC NULLS LAST, part_number ASC NULLS LAST) AS INTEGER)
            AS rank
          FROM fva WHERE forecast_qty > 0 AND actual_qty > 0) r WHERE rank <= 10""",
        *_BASE,
        _FVA_ANY,
        **_INPUTS,
    ),
)
def fva_top_matched(spark, sf):
    return fa.fva_top_matched(_fva_df(spark, sf, "any"), n=10)


@query(
    "forecast_extremes",
    with_tables(
        """SELECT * FROM (SELECT part_number, description, month, forecast_qty, 'top' AS which
            FROM long WHERE forecast_qty > 0
            ORDER BY forecast_qty DESC, part_number, month LIMIT 20) t
          UNION ALL
          SELECT * FROM (SELECT part_number, description, month, forecast_qty, 'bottom'
            FROM long WHERE forecast_qty > 0
            ORDER BY forecast_qty, part_number DESC, month DESC LIMIT 10) b""",
        _LONG,
        wide=FORECAST_WIDE_SQL,
    ),
)
def forecast_extremes(spark, sf):
    long = fa.forecast_unpivot(read(spark, sf, FORECAST_WIDE_SQL)).drop("item")
    return fa.forecast_extremes(long, ["part_number", "month"])


@query(
    "unit_cost",
    with_tables(
        f"""SELECT l.item_code, f.item_name AS product_name,
          {_round("avg(CAST(cogs AS DOUBLE) / CAST(quantity AS DOUBLE))")} AS avg_cogs_per_unit,
          CAST(sum(quantity) AS DOUBLE) AS total_quantity, CAST(sum(cogs) AS DOUBLE) AS total_cogs,
          {_round("CAST(sum(cogs) AS DOUBLE) / CAST(sum(quantity) AS DOUBLE)", 4)} AS total_avg_cogs
        FROM lines l JOIN (SELECT item_code, item_name, row_number() OVER (PARTITION BY item_code
              ORDER BY doc_date, item_name) AS rn FROM lines WHERE quantity > 0 AND cogs > 0) f
          ON f.item_code = l.item_code AND f.rn = 1
        WHERE l.quantity > 0 AND l.cogs > 0 GROUP BY l.item_code, f.item_name""",
        lines=INVOICE_LINES_SQL,
    ),
)
def unit_cost(spark, sf):
    return costs.unit_cost(read(spark, sf, INVOICE_LINES_SQL))


# text rows with bad dates and bad numbers, as an extract would hold them
_RAW_SQL = """
SELECT l_orderkey AS order_no, l_linenumber AS line_no, l_partkey AS part_no,
  l_suppkey AS supplier_no,
  CASE WHEN l_linenumber = 2 THEN 'soon'
    ELSE CAST(CAST(l_shipdate AS DATE) AS VARCHAR(20)) END AS posting_date,
  CASE WHEN l_linenumber = 3 THEN 'n/a' WHEN l_linenumber = 4 THEN ''
    ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR(30)) END AS revenue
FROM {lineitem}
"""


@query(
    "csv_coerced_scan",
    with_tables(
        """SELECT order_no, line_no, part_no, supplier_no,
          TRY_CAST(posting_date AS DATE) AS posting_date,
          coalesce(TRY_CAST(revenue AS DOUBLE), 0) AS revenue FROM raw""",
        raw=_RAW_SQL,
    ),
)
def csv_coerced_scan(spark, sf):
    """The rows written as CSV text, then read by the file reader."""
    path = new_path(spark)
    read(spark, sf, _RAW_SQL).write.csv(path, header=True)
    target = T.StructType.fromDDL(
        "order_no long, line_no int, part_no long, supplier_no long, posting_date date, revenue double"
    )
    return csv_scan(spark, path, target, fill={"revenue": 0.0})
