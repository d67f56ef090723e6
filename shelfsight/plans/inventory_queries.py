"""Inventory documents, transitions, reorder information and out-of-stock periods."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfsight import schemas
from shelfsight.operators import inventory as inv
from shelfsight.operators import oos
from shelfsight.operators.forecast_actual import sku_mapping
from shelfsight.plans.forecast_queries import _mapping_sql, _round
from shelfsight.plans.inputs import (
    CATALOG_SQL,
    INVOICE_LINES_SQL,
    MONTHLY_SALES_SQL,
    SNAPSHOT_SQL,
    read,
    with_tables,
)
from shelfsight.plans.registry import query
from shelfsight.sources.readers import inventory_explode

_AS_OF = "2001-10-01"

_MAP = f"map AS ({_mapping_sql('item_code', 'part_number')})"
_INPUTS = dict(catalog=CATALOG_SQL, lines=INVOICE_LINES_SQL, snap=SNAPSHOT_SQL)


def _mapping(spark, sf):
    return sku_mapping(read(spark, sf, CATALOG_SQL), "item_code", "part_number")


@query("inventory_explode", with_tables("SELECT * FROM snap", snap=SNAPSHOT_SQL))
def explode_documents(spark, sf):
    """Snapshot rows written as one JSON document per SKU (a few months each), and read back."""
    month = F.date_format("month", "yyyy-MM")
    product = F.struct(
        "sku",
        F.col("product_name").alias("productName"),
        F.col("qty_available").alias("qtyAvailable"),
        F.col("velocity_monthly").alias("velocityMonthly"),
        F.col("weeks_of_supply").alias("weeksOfSupply"),
        F.col("at_risk").alias("atRisk"),
        F.col("risk_label").alias("riskLabel"),
    )
    entry = F.struct(month.alias("key"), F.struct(F.array(product).alias("products")).alias("value"))
    documents = (
        read(spark, sf, SNAPSHOT_SQL)
        .groupBy("sku")
        .agg(F.map_from_entries(F.collect_list(entry)).alias("months"))
        .select(F.to_json(F.struct("months")).alias("document"))
    )
    return inventory_explode(documents, text="document").select(
        *schemas.INVENTORY_SNAPSHOT.fieldNames()
    )


_ORDERS = """ord AS (
  SELECT m.part_number AS sku, CAST(date_trunc('month', doc_date) AS DATE) AS month,
    CAST(trunc(sum(quantity)) AS BIGINT) AS order_qty, max(doc_date) AS order_date
  FROM lines l JOIN map m ON m.item_code = l.item_code GROUP BY 1, 2)"""
_BOTH = """b AS (
  SELECT c.month, c.sku, c.product_name, p.at_risk AS was, c.at_risk AS still,
    p.qty_available AS had, c.qty_available AS has, p.weeks_of_supply AS prev_weeks_supply,
    c.weeks_of_supply AS curr_weeks_supply, c.velocity_monthly, c.risk_label,
    o.sku IS NOT NULL AS bought, o.order_qty, o.order_date
  FROM snap c JOIN snap p ON p.sku = c.sku
    AND CAST(p.month + INTERVAL 1 MONTH AS DATE) = c.month
  LEFT JOIN ord o ON o.sku = c.sku AND o.month = c.month)"""
_RULES = {
    "at_risk_reordered": "was AND bought",
    "oos_recovered": "had = 0 AND has > 0",
    "new_at_risk": "NOT was AND still",
    "new_oos": "had > 0 AND has = 0",
    "persistent_at_risk": "was AND still AND NOT bought",
    "persistent_oos": "had = 0 AND has = 0",
    "improved": "was AND NOT still",
}
_TRANSITIONS = "tr AS (" + " UNION ALL ".join(
    f"""SELECT month, sku, '{name}' AS category, product_name, had AS prev_qty, has AS curr_qty,
      has - had AS qty_change, prev_weeks_supply, curr_weeks_supply, velocity_monthly, risk_label,
      bought AS was_ordered, order_qty, order_date, still AS still_at_risk,
      CASE WHEN still THEN 'Still At-Risk' ELSE 'Resolved' END AS status_change
    FROM b WHERE {rule}"""
    for name, rule in _RULES.items()
) + ")"
_CHAIN = (_MAP, _ORDERS, _BOTH, _TRANSITIONS)


def _transitions(spark, sf):
    snapshot = read(spark, sf, SNAPSHOT_SQL)
    orders = inv.orders_by_sku(read(spark, sf, INVOICE_LINES_SQL), _mapping(spark, sf))
    return inv.monthly_transitions(snapshot, orders)


@query("inventory_transitions", with_tables("SELECT * FROM tr", *_CHAIN, **_INPUTS))
def inventory_transitions(spark, sf):
    return _transitions(spark, sf)


_COUNTS = ", ".join(f"count(*) FILTER (WHERE category = '{n}') AS {n}" for n in _RULES)


@query(
    "transition_counts",
    with_tables(f"SELECT month, {_COUNTS} FROM tr GROUP BY month", *_CHAIN, **_INPUTS),
)
def transition_counts(spark, sf):
    return inv.transition_counts(_transitions(spark, sf), by=["month"])


@query(
    "transition_topn",
    with_tables(
        """SELECT * EXCLUDE (cap, rn),
              CASE WHEN cap IS NOT NULL THEN CAST(rn AS INTEGER) END AS rank
            FROM (SELECT *, CASE WHEN category = 'at_risk_reordered' THEN 20
                  WHEN category NOT IN ('oos_recovered', 'new_oos') THEN 10 END AS cap,
                row_number() OVER (PARTITION BY month, category
                  ORDER BY CASE WHEN category = 'at_risk_reordered' AND NOT still_at_risk
                      THEN 1 ELSE 0 END, coalesce(curr_weeks_supply, 0), sku) AS rn
              FROM tr) r
            WHERE cap IS NULL OR rn <= cap""",
        *_CHAIN,
        **_INPUTS,
    ),
)
def transition_topn(spark, sf):
    return inv.transition_topn(_transitions(spark, sf), by=["month"])


_TRACKED = f"""tracked AS (
  SELECT s.*, last_order_date, last_order_qty, last_order_item,
    CAST(date_diff('day', last_order_date, DATE '{_AS_OF}') AS INTEGER) AS days_since_order
  FROM snap s LEFT JOIN (
    SELECT sku, doc_date AS last_order_date, CAST(trunc(quantity) AS BIGINT) AS last_order_qty,
      item_code AS last_order_item
    FROM (SELECT m.part_number AS sku, l.*, row_number() OVER (PARTITION BY m.part_number
            ORDER BY doc_date DESC, quantity DESC, l.item_code DESC) AS rn
          FROM lines l JOIN map m ON m.item_code = l.item_code
          WHERE doc_date <= DATE '{_AS_OF}') r
    WHERE rn = 1) o ON o.sku = s.sku)"""


def _tracked(spark, sf):
    return inv.reorder_tracking(
        read(spark, sf, SNAPSHOT_SQL),
        read(spark, sf, INVOICE_LINES_SQL),
        _mapping(spark, sf),
        _AS_OF,
    )


@query("reorder_tracking", with_tables("SELECT * FROM tracked", _MAP, _TRACKED, **_INPUTS))
def reorder_tracking(spark, sf):
    return _tracked(spark, sf)


_RECENT = """recent AS (SELECT *, coalesce(days_since_order <= 60, false) AS has_recent_order
  FROM tracked WHERE at_risk)"""


@query(
    "reorder_recent", with_tables("SELECT * FROM recent", _MAP, _TRACKED, _RECENT, **_INPUTS)
)
def reorder_recent(spark, sf):
    return inv.reorder_recent(_tracked(spark, sf), 60)


@query(
    "reorder_attention",
    with_tables(
        """SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY month
            ORDER BY coalesce(nullif(weeks_of_supply, 0), 999), sku) AS INTEGER) AS rank
          FROM recent WHERE NOT has_recent_order) r WHERE rank <= 5""",
        _MAP,
        _TRACKED,
        _RECENT,
        **_INPUTS,
    ),
)
def reorder_attention(spark, sf):
    return inv.reorder_attention(_tracked(spark, sf), 60, 5)


@query(
    "reorder_recent_top",
    with_tables(
        """SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY month
            ORDER BY days_since_order, sku) AS INTEGER) AS rank
          FROM recent WHERE has_recent_order) r WHERE rank <= 10""",
        _MAP,
        _TRACKED,
        _RECENT,
        **_INPUTS,
    ),
)
def reorder_recent_top(spark, sf):
    return inv.reorder_recent_top(_tracked(spark, sf), 60, 10)


def _impact(keys: str, start: str, back: str, length: str, volume: str) -> str:
    return f"""{keys}, {start} AS oos_start_month, {back} AS back_in_stock_month,
      CAST({length} AS INTEGER) AS months_oos,
      CAST(round(CAST({length} AS DECIMAL(10,0)) * 4.33, 1) AS DOUBLE) AS weeks_oos,
      {_round(volume)} AS avg_monthly_volume, {_round(f'{volume} * ({length})')} AS lost_units,
      CASE WHEN {back} IS NULL THEN 'Still OOS' ELSE 'Restocked' END AS status,
      CASE WHEN {back} IS NOT NULL THEN CAST(({length}) * 30 AS INTEGER) END AS recovery_time_days"""


# the dense way: every item times every month, then gaps and islands over a carried state
_SALES_RUNS = f"""months AS (
  SELECT CAST(m AS DATE) AS month, CAST(row_number() OVER (ORDER BY m) - 1 AS INTEGER) AS i
  FROM (SELECT unnest(generate_series(min(month), max(month), INTERVAL 1 MONTH)) AS m
    FROM msales) t),
dense AS (
  SELECT k.item, m.month, m.i, coalesce(s.qty, 0) AS qty
  FROM (SELECT DISTINCT item FROM msales) k CROSS JOIN months m
  LEFT JOIN msales s ON s.item = k.item AND s.month = m.month),
carried AS (
  SELECT *, coalesce(last_value(CASE WHEN qty = 0 THEN 1 WHEN qty > 0 THEN 0 END IGNORE NULLS)
      OVER (PARTITION BY item ORDER BY i ROWS UNBOUNDED PRECEDING), 0) AS out,
    sum(qty) OVER (PARTITION BY item ORDER BY i ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS pre
  FROM dense),
opened AS (
  SELECT *, out = 1 AND lag(out, 1, 0) OVER (PARTITION BY item ORDER BY i) = 0 AS opens
  FROM carried),
numbered AS (
  SELECT *, sum(CASE WHEN opens THEN 1 ELSE 0 END)
    OVER (PARTITION BY item ORDER BY i ROWS UNBOUNDED PRECEDING) AS run FROM opened),
spans AS (
  SELECT item, run, min(i) AS start, min(month) AS start_month,
    min(CASE WHEN out = 0 THEN i END) AS back, min(CASE WHEN out = 0 THEN month END) AS back_month,
    max(CASE WHEN opens THEN pre END) AS pre
  FROM numbered WHERE run > 0 GROUP BY item, run),
runs AS (
  SELECT {_impact('item', 'start_month', 'back_month',
    '(coalesce(back, (SELECT count(*) FROM months)) - start)',
    '(CAST(pre AS DOUBLE) / least(start, 3))')}
  FROM spans WHERE pre > 0)"""


def _sales_runs(spark, sf):
    # the history runs from the first to the last month with lines
    first, last = (
        spark.read.parquet(f"{sf}/lineitem.parquet")
        .agg(*(F.trunc(f("l_shipdate"), "month") for f in (F.min, F.max)))
        .first()
    )
    return oos.oos_from_sales(read(spark, sf, MONTHLY_SALES_SQL), first, last)


@query("oos_from_sales", with_tables("SELECT * FROM runs", _SALES_RUNS, msales=MONTHLY_SALES_SQL))
def oos_from_sales(spark, sf):
    return _sales_runs(spark, sf)


_SUMMARY = """SELECT count(*) AS total_oos_periods,
  count(*) FILTER (WHERE status = 'Still OOS') AS still_oos_count,
  count(*) FILTER (WHERE status = 'Restocked') AS restocked_count,
  CAST(coalesce(sum(CAST(lost_units AS DECIMAL(28,2))), 0) AS DOUBLE) AS total_lost_units
FROM runs"""


@query("oos_summary", with_tables(_SUMMARY, _SALES_RUNS, msales=MONTHLY_SALES_SQL))
def oos_summary(spark, sf):
    return oos.oos_summary(_sales_runs(spark, sf))


@query(
    "oos_top",
    with_tables(
        "SELECT * FROM runs ORDER BY lost_units DESC, item, oos_start_month LIMIT 10",
        _SALES_RUNS,
        msales=MONTHLY_SALES_SQL,
    ),
)
def oos_top(spark, sf):
    return oos.oos_top(_sales_runs(spark, sf), 10)


_SNAP_RUNS = f"""months AS (
  SELECT month, row_number() OVER (ORDER BY month) - 1 AS i
  FROM (SELECT DISTINCT month FROM snap) d),
carried AS (
  SELECT s.sku, s.product_name, s.month, m.i,
    coalesce(last_value(CASE WHEN qty_available = 0 THEN 1 WHEN qty_available > 0 THEN 0 END
      IGNORE NULLS) OVER (PARTITION BY sku ORDER BY m.i ROWS UNBOUNDED PRECEDING), 0) AS out,
    avg(CASE WHEN velocity_monthly > 0 THEN velocity_monthly END) OVER (PARTITION BY sku
      ORDER BY m.i RANGE BETWEEN 3 PRECEDING AND 1 PRECEDING) AS pre
  FROM snap s JOIN months m ON m.month = s.month),
opened AS (
  SELECT *, out = 1 AND lag(out, 1, 0) OVER (PARTITION BY sku ORDER BY i) = 0 AS opens
  FROM carried),
numbered AS (
  SELECT *, sum(CASE WHEN opens THEN 1 ELSE 0 END)
    OVER (PARTITION BY sku ORDER BY i ROWS UNBOUNDED PRECEDING) AS run FROM opened),
spans AS (
  SELECT sku, run, min(i) AS start, min(month) AS start_month,
    min(CASE WHEN out = 0 THEN i END) AS back, min(CASE WHEN out = 0 THEN month END) AS back_month,
    max(CASE WHEN opens THEN pre END) AS pre
  FROM numbered WHERE run > 0 GROUP BY sku, run),
runs AS (
  SELECT {_impact('s.sku, n.product_name', 'start_month', 'back_month',
    '(coalesce(back, (SELECT count(*) FROM months)) - start)', 'pre')}
  FROM spans s JOIN (SELECT sku, min_by(product_name, month) AS product_name
    FROM snap GROUP BY sku) n ON n.sku = s.sku
  WHERE pre IS NOT NULL)"""


@query(
    "oos_from_snapshots", with_tables("SELECT * FROM runs", _SNAP_RUNS, snap=SNAPSHOT_SQL)
)
def oos_from_snapshots(spark, sf):
    # a snapshot has the months of the lines, whose dates are one narrow column
    months = spark.read.parquet(f"{sf}/lineitem.parquet").select(
        F.trunc("l_shipdate", "month").cast("date").alias("month")
    )
    return oos.oos_from_snapshots(read(spark, sf, SNAPSHOT_SQL), oos.month_positions(months))
