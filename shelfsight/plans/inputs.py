"""Adapters: the test tables seen as the inputs this library works on.

Every adapter is one SELECT text that Spark and DuckDB both run unchanged, so a query
and its oracle start from the same rows. Only tables that the wanted columns need are
joined, which keeps the scans narrow.

Roles of the years: 2000 is the current year and 1999 the prior one.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

CURRENT = ("2000-01-01", "2001-01-01")
PRIOR = ("1999-01-01", "2000-01-01")

TABLES = ("lineitem", "orders", "customer", "part")

_PART_12 = "lpad(CAST(l_partkey AS VARCHAR(20)), 12, '0')"
_DASHED = (
    "substr({u},1,1) || '-' || substr({u},2,5) || '-' || substr({u},7,5) || '-' || substr({u},12,1)"
)

# column -> (expression, tables it needs besides lineitem)
_TRANSACTION_COLUMNS: dict[str, tuple[str, tuple[str, ...]]] = {
    "posting_date": ("CAST(l_shipdate AS DATE)", ()),
    # an item has two spellings of its name
    "description": (
        "CASE WHEN l_linenumber = 7 THEN upper(p_name) ELSE p_name END",
        ("part",),
    ),
    "brand": ("p_brand", ("part",)),
    # five spellings of one code, plus missing and junk codes
    "item_code": (
        f"CASE l_linenumber WHEN 1 THEN '0' || {_PART_12}"
        f" WHEN 2 THEN {_DASHED.format(u=_PART_12)}"
        " WHEN 3 THEN CAST(l_partkey AS VARCHAR(20))"
        " WHEN 6 THEN CASE l_returnflag WHEN 'A' THEN NULL WHEN 'N' THEN 'n/a'"
        f" ELSE {_PART_12} END"
        f" ELSE {_PART_12} END",
        (),
    ),
    "distributor_item_code": ("'X' || CAST(l_partkey AS VARCHAR(20))", ()),
    "distributor": ("'D-' || l_linestatus", ()),
    "sales_rep": ("o_orderpriority", ("orders",)),
    # customers of one segment buy through their nation: few accounts, many lines each
    "canonical_code": (
        "CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN NULL"
        " WHEN c_mktsegment = 'BUILDING' THEN 'K' || CAST(c_nationkey AS VARCHAR(20))"
        " ELSE 'C' || CAST(o_custkey AS VARCHAR(20)) END",
        ("orders", "customer"),
    ),
    "base_card_code": ("'B' || CAST(o_custkey AS VARCHAR(20))", ("orders",)),
    "ship_to_code": ("'S-' || o_orderstatus", ("orders",)),
    "quantity": ("CAST(l_quantity AS DECIMAL(18,2))", ()),
    "revenue": (
        "CASE WHEN l_linenumber = 5 THEN NULL"
        " WHEN l_returnflag = 'R' AND l_linenumber IN (1, 3, 7)"
        " THEN -CAST(l_extendedprice AS DECIMAL(18,2))"
        " ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END",
        (),
    ),
    "amount": ("CAST(l_extendedprice AS DECIMAL(18,2))", ()),
    "transaction_hash": (
        "md5(CAST(l_orderkey AS VARCHAR(20)) || '-' || CAST(l_linenumber AS VARCHAR(20))"
        " || '-' || CAST(l_partkey AS VARCHAR(20)) || '-' || CAST(l_suppkey AS VARCHAR(20)))",
        (),
    ),
}

_JOINS = {
    "orders": "JOIN {orders} ON o_orderkey = l_orderkey",
    "customer": "JOIN {customer} ON c_custkey = o_custkey",
    "part": "JOIN {part} ON p_partkey = l_partkey",
}

FACT_COLUMNS = tuple(c for c in _TRANSACTION_COLUMNS if c != "brand")
SALES_COLUMNS = ("posting_date", "description", "quantity", "revenue", "amount")


def transactions_sql(*columns: str) -> str:
    columns = columns or FACT_COLUMNS
    needed = {table for c in columns for table in _TRANSACTION_COLUMNS[c][1]}
    picked = ",\n  ".join(f"{_TRANSACTION_COLUMNS[c][0]} AS {c}" for c in columns)
    joins = "\n".join(text for table, text in _JOINS.items() if table in needed)
    return f"SELECT {picked}\nFROM {{lineitem}}\n{joins}"


LAUNCH_LIST_SQL = f"""
SELECT p_name || ' ' || CAST(p_partkey AS VARCHAR(20)) AS product_label,
  {_DASHED.format(u="lpad(CAST(p_partkey AS VARCHAR(20)), 12, '0')")} AS upc_dashed
FROM {{part}} WHERE p_brand = 'Brand#7' AND p_type = 'PROMO'
UNION ALL SELECT 'Never sold', '9-99999-99999-9'
"""

# Signed quantities, free lines and a price book: the invoice extract.
INVOICE_LINES_SQL = """
SELECT CAST(l_shipdate AS DATE) AS doc_date,
  'I' || CAST(l_partkey AS VARCHAR(20)) AS item_code,
  p_name AS item_name,
  CAST(CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN -l_quantity ELSE l_quantity END
    AS DECIMAL(18,2)) AS quantity,
  CAST(l_extendedprice AS DECIMAL(18,2)) AS line_total,
  CAST(CASE WHEN l_linenumber = 6 THEN 0 ELSE p_retailprice * l_quantity END
    AS DECIMAL(18,2)) AS cogs
FROM {lineitem} JOIN {part} ON p_partkey = l_partkey
"""

# Parts of one type are listed twice, the later line with another item; some lines lack one.
CATALOG_SQL = """
SELECT 'P' || CAST(p_partkey AS VARCHAR(20)) AS part_number,
  CAST(710000000000 + p_partkey AS VARCHAR(20))
    || CASE WHEN p_type = 'PROMO' THEN '.0' ELSE '' END AS upc_code,
  CASE WHEN p_brand = 'Brand#7' THEN 'nan' WHEN p_brand = 'Brand#9' THEN ' '
    ELSE ' I' || CAST(p_partkey AS VARCHAR(20)) || ' ' END AS item_code,
  2 * p_partkey AS line_no
FROM {part}
UNION ALL
SELECT 'P' || CAST(p_partkey AS VARCHAR(20)),
  CAST(720000000000 + p_partkey AS VARCHAR(20)),
  'I' || CAST(p_partkey AS VARCHAR(20)),
  2 * p_partkey + 1
FROM {part} WHERE p_type = 'SMALL'
"""

MONTHLY_SALES_SQL = """
SELECT 'I' || CAST(l_partkey AS VARCHAR(20)) AS item,
  CAST(date_trunc('month', l_shipdate) AS DATE) AS month,
  CAST(sum(CASE WHEN l_returnflag = 'R' THEN -l_quantity WHEN l_returnflag = 'A' THEN 0
    ELSE l_quantity END) AS DECIMAL(18,2)) AS qty
FROM {lineitem}
GROUP BY l_partkey, CAST(date_trunc('month', l_shipdate) AS DATE)
"""

# On hand = lines kept less lines returned: zero, positive and negative stock all occur,
# and an item has no row for a month without lines.
SNAPSHOT_SQL = """
SELECT month, sku, product_name, qty_available, velocity_monthly, weeks_of_supply,
  coalesce(weeks_of_supply < 4, false) AS at_risk,
  CASE WHEN coalesce(weeks_of_supply < 4, false) THEN 'Critical' ELSE 'Low' END AS risk_label
FROM (
  SELECT month, 'P' || CAST(l_partkey AS VARCHAR(20)) AS sku, p_name AS product_name,
    qty_available, velocity_monthly,
    CASE WHEN velocity_monthly > 0 THEN qty_available / (velocity_monthly / 4.33e0) END
      AS weeks_of_supply
  FROM (
    SELECT l_partkey, CAST(date_trunc('month', l_shipdate) AS DATE) AS month,
      CAST(sum(CASE l_returnflag WHEN 'N' THEN l_quantity WHEN 'R' THEN -l_quantity ELSE 0 END)
        AS BIGINT) AS qty_available,
      sum(CASE WHEN l_returnflag <> 'R' THEN l_quantity END) AS velocity_monthly
    FROM {lineitem}
    GROUP BY l_partkey, CAST(date_trunc('month', l_shipdate) AS DATE)
  ) m JOIN {part} ON p_partkey = l_partkey
) s
"""

FORECAST_MONTHS = tuple(f"{CURRENT[0][:4]}-{m:02d}" for m in range(1, 13))

# One line per part; last year's month is the forecast, 0 where only samples went out.
FORECAST_WIDE_SQL = (
    """
SELECT 'P' || CAST(p_partkey AS VARCHAR(20)) AS part_number,
  CASE p_type WHEN 'ECONOMY' THEN 'I' || CAST(p_partkey AS VARCHAR(20))
    WHEN 'SMALL' THEN 'nan' WHEN 'PROMO' THEN '' ELSE NULL END AS item,
  p_name AS description,
"""
    + ",\n".join(
        f"  sum(CASE WHEN month(l_shipdate) = {m} THEN"
        " CASE WHEN l_returnflag = 'A' THEN 0 ELSE l_quantity * 0.75e0 END END)"
        f' AS {{q}}{name}{{q}}'
        for m, name in enumerate(FORECAST_MONTHS, 1)
    )
    + """
FROM {lineitem} JOIN {part} ON p_partkey = l_partkey
WHERE l_shipdate >= TIMESTAMP '1999-01-01 00:00:00' AND l_shipdate < TIMESTAMP '2000-01-01 00:00:00'
GROUP BY p_partkey, p_type, p_name
"""
)


def read(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """Run an adapter text in Spark on the parquet tables of ``sf_dir``."""
    used = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if f"{{{t}}}" in sql}
    return spark.sql(sql.replace("{q}", "`"), **used)


def transactions(
    spark: SparkSession, sf_dir: str, *columns: str, lo: str | None = None, hi: str | None = None
) -> DataFrame:
    """The sales lines. ``lo`` and ``hi`` repeat the query's own date range on the stored
    timestamp, where the Parquet scan can use it; a table with a DATE column needs no such
    help."""
    bounds = [
        f"l_shipdate {sign} TIMESTAMP '{day} 00:00:00'"
        for sign, day in ((">=", lo), ("<", hi))
        if day is not None
    ]
    where = f"\nWHERE {' AND '.join(bounds)}" if bounds else ""
    return read(spark, sf_dir, _by_order(columns or FACT_COLUMNS, where))


def _by_order(columns: tuple[str, ...], where: str) -> str:
    """The rows of ``transactions_sql``, for Spark, which joins in the order of the text.

    What comes from orders and customers is worked out per order, and what comes from lines
    before they move, so that lines move once, for their orders, and with few columns.
    """
    needs = {c: _TRANSACTION_COLUMNS[c] for c in columns}
    of_order = [c for c, (_, tables) in needs.items() if "orders" in tables]
    if not of_order:
        return transactions_sql(*columns) + where
    of_line = [c for c, (_, tables) in needs.items() if not tables]
    of_part = [c for c, (_, tables) in needs.items() if "part" in tables]
    plain = sorted({name for c in of_part for name in re.findall(r"\bl_\w+", needs[c][0])} | {"l_orderkey", "l_partkey"})

    def named(names: list[str]) -> list[str]:
        return [f"{needs[c][0]} AS {c}" for c in names]

    customer = _JOINS["customer"] if any("customer" in needs[c][1] for c in of_order) else ""
    picked = ", ".join(named([c])[0] if c in of_part else c for c in columns)
    return f"""SELECT {picked}
FROM (SELECT {", ".join([*plain, *named(of_line)])} FROM {{lineitem}}{where})
JOIN (SELECT o_orderkey, {", ".join(named(of_order))} FROM {{orders}} {customer})
  ON o_orderkey = l_orderkey
{_JOINS["part"] if of_part else ""}"""


def duck(sql: str) -> str:
    """The same text for DuckDB."""
    for table in TABLES:
        sql = sql.replace(f"{{{table}}}", table)
    return sql.replace("{q}", '"')


def with_tables(body: str, *extra: str, **inputs: str) -> str:
    """``body`` behind a WITH list of adapter texts."""
    heads = [f"{name} AS ({duck(sql)})" for name, sql in inputs.items()]
    return "WITH " + ",\n".join([*heads, *extra]) + "\n" + body
