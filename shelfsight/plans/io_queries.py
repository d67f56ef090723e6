"""Sources and sinks, checked by what comes back from the files they write and read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfsight import schemas
from shelfsight.functions import net_revenue
from shelfsight.operators import forecast_actual as fa
from shelfsight.operators import reorder, sales
from shelfsight.operators.staging import new_path
from shelfsight.plans.forecast_queries import (
    _BASE, _FVA, _PAID, _REFRESHED, _fva_df, _month_sql, _refreshed,
)
from shelfsight.plans.forecast_queries import _INPUTS as _FVA_INPUTS
from shelfsight.plans.inputs import (
    CURRENT, INVOICE_LINES_SQL, SNAPSHOT_SQL, read, transactions, transactions_sql, with_tables,
)
from shelfsight.plans.registry import query
from shelfsight.sources import month_table
from shelfsight.sources.ordered import read_csv_in_order
from shelfsight.sources.readers import load_transactions, read_inventory_documents, scan_month_files
from shelfsight.sources.sinks import write_csv, write_documents


@query(
    "transactions_loaded",
    with_tables(
        """SELECT * REPLACE (CAST(quantity AS DOUBLE) AS quantity, CAST(revenue AS DOUBLE) AS revenue,
          CAST(amount AS DOUBLE) AS amount) FROM transactions""",
        transactions=transactions_sql(),
    ),
)
def transactions_loaded(spark, sf):
    """The sales lines as a stored table, read by the loader with its declared schema."""
    path = new_path(spark)
    transactions(spark, sf).write.parquet(path)
    return load_transactions(spark, path)


@query(
    "month_files_scan",
    with_tables(
        """SELECT CAST(date_trunc('month', doc_date) AS DATE) AS month, item_code, item_name,
          CASE WHEN month(doc_date) % 3 <> 2 THEN CAST(quantity AS DOUBLE) END AS quantity,
          CAST(line_total AS DOUBLE) AS line_total FROM lines""",
        lines=INVOICE_LINES_SQL,
    ),
)
def month_files_scan(spark, sf):
    """Invoice lines in a file per month, in three column orders, one without a quantity."""
    path = new_path(spark)
    lines = read(spark, sf, INVOICE_LINES_SQL).withColumn(
        "file", F.lower(F.date_format("doc_date", "MMMM_yyyy"))
    )
    orders = (
        ["item_code", "item_name", "quantity", "line_total", "cogs"],
        ["line_total", "cogs", "quantity", "item_name", "item_code"],
        ["item_name", "line_total", "item_code"],
    )
    for rest, columns in enumerate(orders):
        some = lines.where(F.month("doc_date") % 3 == rest)
        some.select("file", *columns).write.partitionBy("file").csv(f"{path}/order_{rest}", header=True)
    schema = T.StructType.fromDDL("item_code string, item_name string, quantity double, line_total double")
    # the month stands in the folder here, so the name pattern reads the whole path
    return scan_month_files(
        spark, f"{path}/order_*/*/", schema, r"file=([a-z]+)_(\d{4})", by_path=True
    )


def _product_line() -> Column:
    fields = {"sku": "sku", "productName": "product_name", "qtyAvailable": "qty_available",
              "velocityMonthly": "velocity_monthly", "weeksOfSupply": "weeks_of_supply",
              "atRisk": "at_risk", "riskLabel": "risk_label"}
    return F.to_json(F.struct(*(F.col(column).alias(name) for name, column in fields.items())))


def _write_document_per_month(snapshot: DataFrame, path: str) -> None:
    """A file per month with one document of many lines, products in the order of their SKU."""
    key = F.date_format("month", "yyyy-MM")
    first = F.row_number().over(Window.partitionBy("month").orderBy("sku")) == 1
    products = snapshot.select(
        key.alias("key"), F.lit(1).alias("part"), "sku",
        F.concat(F.when(first, F.lit("  ")).otherwise(F.lit(", ")), _product_line()).alias("value"),
    )
    keys = snapshot.select(key.alias("key")).distinct()
    none = F.lit("").alias("sku")
    head = F.concat(F.lit('{"months": {"'), "key", F.lit('": {"products": ['))
    frame = [keys.select("key", F.lit(n).alias("part"), none, text.alias("value"))
             for n, text in ((0, head), (2, F.lit("]}}}")))]
    lines = products.unionByName(frame[0]).unionByName(frame[1])
    lines.repartition("key").sortWithinPartitions("key", "part", "sku").select(
        "value", F.col("key").alias("file_key")
    ).write.partitionBy("file_key").text(path)


@query("inventory_document_split", with_tables("SELECT * FROM snap", snap=SNAPSHOT_SQL))
def inventory_document_split(spark, sf):
    """Snapshot rows written as a document of many lines per month, read back in blocks."""
    path = new_path(spark)
    _write_document_per_month(read(spark, sf, SNAPSHOT_SQL), path)
    return read_inventory_documents(spark, f"{path}/*/", multi_line=True).select(
        *schemas.INVENTORY_SNAPSHOT.fieldNames()
    )


@query(
    "sorted_csv_roundtrip",
    with_tables(
        f"""SELECT *, row_number() OVER (ORDER BY month, revenue_ytd DESC NULLS FIRST, product_name) AS position
        FROM (SELECT CAST(date_trunc('month', posting_date) AS DATE) AS month, description AS product_name,
            CAST(sum(coalesce(revenue, amount)) AS DOUBLE) AS revenue_ytd, count(*) AS txn_count
          FROM transactions WHERE posting_date >= DATE '{CURRENT[0]}' AND posting_date < DATE '{CURRENT[1]}'
          GROUP BY 1, 2) s""",
        transactions=transactions_sql("posting_date", "description", "revenue", "amount", "quantity"),
    ),
)
def sorted_csv_roundtrip(spark, sf):
    """The monthly summary through the ordered CSV sink; positions across its part files."""
    lines = transactions(spark, sf, "posting_date", "description", "revenue", "amount", "quantity",
                         lo=CURRENT[0], hi=CURRENT[1])
    summary = sales.monthly_summary(lines, *CURRENT).select(
        "month", "product_name", F.col("revenue").cast("double").alias("revenue_ytd"), "txn_count"
    )
    path = new_path(spark)
    write_csv(summary, path, ["month", F.col("revenue_ytd").desc_nulls_first(), "product_name"])
    schema = T.StructType.fromDDL("month date, product_name string, revenue_ytd double, txn_count long")
    return read_csv_in_order(spark, path, schema)


@query("document_roundtrip", with_tables("SELECT * FROM snap", snap=SNAPSHOT_SQL))
def document_roundtrip(spark, sf):
    """Snapshot rows through the JSON sink, NULL fields kept, read with the declared schema."""
    path = new_path(spark)
    write_documents(read(spark, sf, SNAPSHOT_SQL), path)
    return spark.read.schema(schemas.INVENTORY_SNAPSHOT).json(path)


@query(
    "stored_month_upsert",
    with_tables(
        "SELECT * FROM older WHERE month < DATE '2000-07-01' UNION ALL SELECT * FROM newer",
        *_BASE,
        _FVA,
        _PAID,
        _REFRESHED,
        f"older AS ({_month_sql('fva')})",
        f"newer AS ({_month_sql('refreshed')} WHERE month >= DATE '2000-07-01')",
        **_FVA_INPUTS,
    ),
)
def stored_month_upsert(spark, sf):
    """The month summary stored, its second half replaced, and the table read back."""
    path = new_path(spark)
    month_table.upsert_months(fa.fva_month_summary(_fva_df(spark, sf)), path)
    newer = fa.fva_month_summary(_refreshed(spark, sf)).where("month >= DATE '2000-07-01'")
    month_table.upsert_months(newer, path)
    return month_table.read_months(spark, path)


@query(
    "paid_invoices_without_optional",
    with_tables(
        """SELECT distributor, canonical_code AS account_id, posting_date AS invoice_date,
          CAST(sum(coalesce(revenue, amount, 0)) AS DOUBLE) AS revenue,
          CAST(sum(coalesce(quantity, 0)) AS DOUBLE) AS units, min(description) AS product_name
        FROM transactions GROUP BY 1, 2, 3 HAVING sum(coalesce(revenue, amount, 0)) > 0""",
        transactions=transactions_sql(
            "posting_date", "description", "distributor", "canonical_code", "quantity", "revenue", "amount"
        ),
    ),
)
def paid_invoices_without_optional(spark, sf):
    """Paid invoices of lines that have neither a ship-to code nor a sales rep."""
    lines = transactions(
        spark, sf, "posting_date", "description", "distributor", "canonical_code", "quantity", "revenue", "amount"
    )
    return reorder.paid_invoices(
        lines.select(
            "distributor", "canonical_code", "posting_date", net_revenue().alias("revenue"), "quantity",
            F.col("description").alias("product_name"),
        )
    )
