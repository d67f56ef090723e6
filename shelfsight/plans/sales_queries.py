"""Sales lines, summaries, product ranking and launches."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfsight.functions import upc_from_number, upc_from_sheet_text, upc_norm12
from shelfsight.operators import sales
from shelfsight.plans.inputs import (
    CATALOG_SQL,
    CURRENT,
    LAUNCH_LIST_SQL,
    PRIOR,
    SALES_COLUMNS,
    read,
    transactions,
    transactions_sql,
    with_tables,
)
from shelfsight.plans.registry import query

_CY = f"posting_date >= DATE '{CURRENT[0]}' AND posting_date < DATE '{CURRENT[1]}'"
_SINCE_PRIOR = f"posting_date >= DATE '{PRIOR[0]}'"

# digits of the code first, then the three length cases
_UPC = """coded AS (
  SELECT *, CASE WHEN length(digits) = 13 AND substr(digits, 1, 1) = '0' THEN substr(digits, 2)
      WHEN length(digits) < 12 THEN lpad(digits, 12, '0') ELSE digits END AS upc_norm12
  FROM (SELECT *, regexp_replace(coalesce(item_code, ''), '[^0-9]', '', 'g') AS digits
        FROM transactions) t
)"""
_LISTED = """listed AS (
  SELECT product_label AS sku_name, CASE WHEN length(d) < 12 THEN lpad(d, 12, '0') ELSE d END
    AS upc_norm12
  FROM (SELECT product_label, regexp_replace(upc_dashed, '[^0-9]', '', 'g') AS d FROM launches) x
)"""


def _summary_sql(key: str, alias: str, *needs: str, revenue="revenue_ytd", units="units_ytd") -> str:
    return with_tables(
        f"""SELECT {key} AS {alias}, description AS product_name,
          CAST(sum(coalesce(revenue, amount)) AS DOUBLE) AS {revenue},
          CAST(sum(quantity) AS DOUBLE) AS {units}, count(*) AS txn_count
        FROM transactions WHERE {_CY} GROUP BY 1, 2""",
        transactions=transactions_sql(*SALES_COLUMNS, *needs),
    )


def _lines(spark, sf, *columns):
    return transactions(spark, sf, *columns, lo=CURRENT[0], hi=CURRENT[1])


@query(
    "upc_normalise",
    with_tables(
        "SELECT item_code, upc_norm12, count(*) AS n_lines FROM coded GROUP BY 1, 2",
        _UPC,
        transactions=transactions_sql("item_code"),
    ),
)
def upc_normalise(spark, sf):
    return (
        transactions(spark, sf, "item_code")
        .groupBy("item_code", upc_norm12("item_code").alias("upc_norm12"))
        .agg(F.count(F.lit(1)).alias("n_lines"))
    )


@query(
    "upc_from_number",
    with_tables(
        """SELECT line_no, upc_code,
          CASE WHEN length(n) < 12 THEN lpad(n, 12, '0') ELSE n END AS upc_number,
          CASE WHEN length(s) < 12 THEN lpad(s, 12, '0') ELSE s END AS upc_text
        FROM (SELECT *, CAST(CAST(trunc(TRY_CAST(upc_code AS DOUBLE)) AS BIGINT) AS VARCHAR) AS n,
                regexp_replace(upc_code, '\\.0$', '') AS s FROM catalog) c""",
        catalog=CATALOG_SQL,
    ),
)
def upc_numbers(spark, sf):
    return read(spark, sf, CATALOG_SQL).select(
        "line_no",
        "upc_code",
        upc_from_number("upc_code").alias("upc_number"),
        upc_from_sheet_text("upc_code").alias("upc_text"),
    )


_DETAIL = """SELECT posting_date, CAST(year(posting_date) AS INTEGER) AS "year",
    'Q' || CAST(quarter(posting_date) AS VARCHAR) AS quarter, description AS product_name,
    item_code AS upc_item_code_raw, upc_norm12 AS upc_item_code_norm12, distributor_item_code,
    distributor, sales_rep, canonical_code, base_card_code, ship_to_code,
    CAST(quantity AS DOUBLE) AS quantity, CAST(coalesce(revenue, amount) AS DOUBLE) AS revenue,
    CAST(amount AS DOUBLE) AS amount_raw, transaction_hash
  FROM coded WHERE """ + _CY


@query("transaction_detail", with_tables(_DETAIL, _UPC, transactions=transactions_sql()))
def transaction_detail(spark, sf):
    return sales.transaction_detail(_lines(spark, sf), *CURRENT)


@query(
    "launch_transactions",
    with_tables(
        _DETAIL + " AND upc_norm12 IN (SELECT upc_norm12 FROM listed)",
        _UPC,
        _LISTED,
        transactions=transactions_sql(),
        launches=LAUNCH_LIST_SQL,
    ),
)
def launch_transactions(spark, sf):
    launches = read(spark, sf, LAUNCH_LIST_SQL)
    return sales.launch_transactions(_lines(spark, sf), launches, *CURRENT)


@query(
    "monthly_summary",
    _summary_sql(
        "CAST(date_trunc('month', posting_date) AS DATE)", "month", revenue="revenue", units="units"
    ),
)
def monthly_summary(spark, sf):
    return sales.monthly_summary(_lines(spark, sf, *SALES_COLUMNS), *CURRENT)


@query("distributor_summary", _summary_sql("distributor", "distributor", "distributor"))
def distributor_summary(spark, sf):
    return sales.distributor_summary(
        _lines(spark, sf, *SALES_COLUMNS, "distributor"), *CURRENT
    )


@query("salesrep_summary", _summary_sql("sales_rep", "sales_rep", "sales_rep"))
def salesrep_summary(spark, sf):
    return sales.salesrep_summary(_lines(spark, sf, *SALES_COLUMNS, "sales_rep"), *CURRENT)


@query("account_summary", _summary_sql("canonical_code", "canonical_code", "canonical_code"))
def account_summary(spark, sf):
    return sales.account_summary(
        _lines(spark, sf, *SALES_COLUMNS, "canonical_code"), *CURRENT
    )


@query(
    "accounts_topn",
    with_tables(
        """SELECT canonical_code, product_name, CAST(revenue AS DOUBLE) AS revenue_ytd,
          CAST(units AS DOUBLE) AS units_ytd, txn_count, CAST(rn AS INTEGER) AS rank
        FROM (SELECT *, row_number() OVER (PARTITION BY product_name
                ORDER BY revenue DESC NULLS FIRST, canonical_code ASC NULLS LAST) AS rn
              FROM acct) r
        WHERE rn <= 50""",
        f"""acct AS (
          SELECT canonical_code, description AS product_name,
            sum(coalesce(revenue, amount)) AS revenue, sum(quantity) AS units,
            count(*) AS txn_count
          FROM transactions WHERE {_CY} GROUP BY 1, 2)""",
        transactions=transactions_sql(*SALES_COLUMNS, "canonical_code"),
    ),
)
def accounts_topn(spark, sf):
    return sales.accounts_topn(
        _lines(spark, sf, *SALES_COLUMNS, "canonical_code"), *CURRENT, n=50
    )


@query(
    "sku_names",
    with_tables(
        """SELECT upc_norm12, description AS sku_name, c AS lines
        FROM (SELECT *, row_number() OVER (PARTITION BY upc_norm12
                ORDER BY c DESC, description ASC NULLS LAST) AS rn FROM counted) r
        WHERE rn = 1""",
        _UPC,
        f"""counted AS (SELECT upc_norm12, description, count(*) AS c FROM coded
          WHERE {_CY} GROUP BY 1, 2)""",
        transactions=transactions_sql("posting_date", "item_code", "description"),
    ),
)
def sku_names(spark, sf):
    return sales.sku_names(
        _lines(spark, sf, "posting_date", "item_code", "description"), *CURRENT
    )


def _growth_sql(tail: str) -> str:
    return with_tables(
        """SELECT coalesce(n.description, c.upc_norm12) AS sku_name, c.upc_norm12,
          CAST(c.revenue AS DOUBLE) AS ytd_revenue, CAST(c.units AS DOUBLE) AS ytd_units,
          CASE WHEN l.revenue > 0
            THEN CAST(c.revenue AS DOUBLE) / CAST(l.revenue AS DOUBLE) - 1 END AS growth_rate,
          CAST(NULL AS DOUBLE) AS profit_margin
        FROM cy c LEFT JOIN ly l ON l.upc_norm12 = c.upc_norm12
        LEFT JOIN names n ON n.upc_norm12 = c.upc_norm12 """
        + tail,
        _UPC,
        f"""cy AS (SELECT upc_norm12, sum(coalesce(revenue, amount)) AS revenue,
            sum(coalesce(quantity, 0)) AS units
          FROM coded WHERE posting_date >= DATE '{CURRENT[0]}' GROUP BY 1)""",
        f"""ly AS (SELECT upc_norm12, sum(coalesce(revenue, amount)) AS revenue
          FROM coded WHERE {_SINCE_PRIOR} AND posting_date < DATE '{PRIOR[1]}' GROUP BY 1)""",
        f"""names AS (SELECT upc_norm12, description FROM (
            SELECT upc_norm12, description, row_number() OVER (PARTITION BY upc_norm12
              ORDER BY count(*) DESC, description ASC NULLS LAST) AS rn
            FROM coded WHERE posting_date >= DATE '{CURRENT[0]}' GROUP BY 1, 2) r
          WHERE rn = 1)""",
        transactions=transactions_sql(*SALES_COLUMNS, "item_code"),
    )


@query("sku_growth", _growth_sql(""))
def sku_growth(spark, sf):
    tx = transactions(spark, sf, *SALES_COLUMNS, "item_code", lo=PRIOR[0])
    return sales.sku_growth(tx, CURRENT[0], None, *PRIOR)


@query(
    "top_skus_growth",
    _growth_sql("ORDER BY c.revenue DESC NULLS FIRST, c.upc_norm12 LIMIT 10"),
)
def top_skus_growth(spark, sf):
    tx = transactions(spark, sf, *SALES_COLUMNS, "item_code", lo=PRIOR[0])
    return sales.top_skus_growth(tx, CURRENT[0], None, *PRIOR, n=10)


@query(
    "launch_performance",
    with_tables(
        """SELECT l.sku_name, l.upc_norm12,
          CAST(coalesce(s.cy, 0) AS DOUBLE) AS ytd_revenue,
          CAST(coalesce(s.units, 0) AS DOUBLE) AS ytd_units,
          CASE WHEN s.ly > 0
            THEN CAST(coalesce(s.cy, 0) AS DOUBLE) / CAST(s.ly AS DOUBLE) - 1 END AS growth_rate,
          CAST(NULL AS DOUBLE) AS profit_margin
        FROM listed l LEFT JOIN sold s ON s.upc_norm12 = l.upc_norm12""",
        _UPC,
        _LISTED,
        f"""sold AS (SELECT upc_norm12,
            sum(coalesce(revenue, amount)) FILTER (WHERE posting_date >= DATE '{CURRENT[0]}') AS cy,
            sum(coalesce(quantity, 0)) FILTER (WHERE posting_date >= DATE '{CURRENT[0]}') AS units,
            sum(coalesce(revenue, amount)) FILTER (WHERE posting_date < DATE '{PRIOR[1]}') AS ly
          FROM coded WHERE {_SINCE_PRIOR} GROUP BY 1)""",
        transactions=transactions_sql(*SALES_COLUMNS, "item_code"),
        launches=LAUNCH_LIST_SQL,
    ),
)
def launch_performance(spark, sf):
    tx = transactions(spark, sf, *SALES_COLUMNS, "item_code", lo=PRIOR[0])
    return sales.launch_performance(
        tx, read(spark, sf, LAUNCH_LIST_SQL), CURRENT[0], None, *PRIOR
    )
