"""Readers: sales tables, all-text CSV, one-file-per-month folders and inventory documents."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfsight import schemas
from shelfsight.functions import to_number

# The month names an inventory document may use as keys.
MONTH_NAMES = (
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
)


_SPLIT = ("partitionColumn", "lowerBound", "upperBound", "numPartitions")
ISO_DATE = "yyyy-MM-dd"


def load_transactions(
    spark: SparkSession,
    path: str | None = None,
    *,
    jdbc: Mapping[str, str] | None = None,
) -> DataFrame:
    """The sales fact table, from Parquet or over JDBC.

    For JDBC give ``url`` and ``dbtable`` (or ``query``), and ``partitionColumn`` with
    ``lowerBound``, ``upperBound`` and ``numPartitions``, since an unsplit read runs in one
    task.
    """
    if (path is None) == (jdbc is None):
        raise ValueError("give either a path or JDBC options")
    if path is not None:
        return spark.read.schema(schemas.TRANSACTIONS).parquet(path)
    missing = [o for o in _SPLIT if o not in jdbc]
    if missing:
        raise ValueError(f"a JDBC read is split; give {', '.join(missing)}")
    return spark.read.format("jdbc").options(**jdbc).load()


def _date(text: Column, formats: Sequence[str]) -> Column:
    """A date in the first of some forms that fits; any other text is NULL.

    The ISO form may be followed by a time.
    """
    trimmed = F.trim(text)
    tried = []
    for form in formats:
        if form == ISO_DATE:
            iso = trimmed.rlike(r"^\d{4}-\d{2}-\d{2}([ T].*)?$")
            tried.append(F.when(iso, trimmed.try_cast("date")))
        else:
            tried.append(F.try_to_date(trimmed, form))
    return F.coalesce(*tried)


def _coerced(
    df: DataFrame, field: T.StructField, formats: Sequence[str]
) -> Column:
    if field.name not in df.columns:
        return F.lit(None).cast(field.dataType)
    if isinstance(field.dataType, T.DateType):
        return _date(F.col(field.name), formats)
    if isinstance(field.dataType, T.DecimalType):
        text = F.col(field.name)
        return F.when(to_number(text).isNotNull(), F.trim(text).try_cast(field.dataType))
    if isinstance(field.dataType, T.NumericType):
        return to_number(field.name).try_cast(field.dataType)
    return F.col(field.name).try_cast(field.dataType)


def coerce_strings(
    df: DataFrame,
    schema: T.StructType,
    fill: Mapping[str, object] | None = None,
    date_formats: Sequence[str] = (ISO_DATE,),
) -> DataFrame:
    """Cast all-text columns to ``schema``: bad values become NULL, then ``fill``.

    Columns that are missing from ``df`` become NULL (or ``fill``) as well. Dates are read
    in the first of ``date_formats`` that fits.
    """
    fill = fill or {}

    def one(field: T.StructField) -> Column:
        value = _coerced(df, field, date_formats)
        if field.name in fill:
            value = F.coalesce(value, F.lit(fill[field.name]).cast(field.dataType))
        return value.alias(field.name)

    return df.select(*(one(field) for field in schema))


def rejected_cells(
    df: DataFrame, schema: T.StructType, date_formats: Sequence[str] = (ISO_DATE,)
) -> DataFrame:
    """One row: per column of ``schema`` how many texts that are not blank were not read."""
    return df.agg(
        *(
            F.count_if(
                (F.trim(F.col(f.name).cast("string")) != "") & _coerced(df, f, date_formats).isNull()
            ).alias(f.name)
            for f in schema
            if f.name in df.columns
        )
    )


_FIELD = r'("(?:[^"]|"")*"|[^,]*)(?:,|$)'


def csv_headers(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``file, header``: the column names of each CSV file, found in one distributed read.

    Rows of a file's first block are numbered by the task that reads them; the first of them
    is found by an aggregate per file, of which little moves.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
        "value",
    )
    first = lines.where("block = 0").groupBy("file").agg(F.min_by("value", "row").alias("line"))
    line = F.regexp_replace("line", "^\\ufeff", "")
    # a pattern that may end in nothing also matches after the last field
    fields = F.regexp_extract_all(line, F.lit(_FIELD), F.lit(1))
    count = F.size(fields) - F.when(F.endswith(line, F.lit(",")), 0).otherwise(1)
    whole = F.transform(
        F.slice(fields, F.lit(1), F.greatest(count, F.lit(1))),
        lambda f: F.when(
            f.startswith('"'), F.replace(F.substr(f, F.lit(2), F.length(f) - 2), F.lit('""'), F.lit('"'))
        ).otherwise(f),
    )
    return first.select("file", whole.alias("header"))


def _read_csv_by_name(
    spark: SparkSession, path: str | list[str], names: Sequence[str], *more: Column
) -> DataFrame:
    """CSV files with headers as one table of text by column name, whatever each file's order.

    One job finds how wide the widest header is; after it the files are read once more, by
    position, and every row looks its columns up in its own file's header. A column that a
    file lacks is NULL there. A file without a header line has no rows.
    """
    headers = csv_headers(spark, path)
    widest = headers.agg(F.max(F.size("header"))).first()[0]
    if widest is None:
        raise FileNotFoundError(f"no CSV file with a header at {path}")
    positions = [f"_c{i}" for i in range(widest)]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in positions])
    rows = spark.read.schema(schema).csv(path, header=True).select(
        F.array(*positions).alias("__cells"), F.col("_metadata.file_path").alias("__file"), *more
    )
    places = headers.select(
        F.col("file").alias("__of"),
        *(F.nullif(F.array_position("header", F.lit(name)), F.lit(0)).cast("int").alias(f"__at_{i}")
          for i, name in enumerate(names)),
    )
    found = rows.join(places, F.col("__file") == F.col("__of"))
    kept = [c for c in rows.columns if c not in ("__cells", "__file")]
    return found.select(
        *(F.try_element_at("__cells", F.col(f"__at_{i}")).alias(name) for i, name in enumerate(names)),
        *kept,
    )


def csv_coerced_scan(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    fill: Mapping[str, object] | None = None,
    date_formats: Sequence[str] = (ISO_DATE,),
) -> DataFrame:
    """CSV with headers, read as text by column name and coerced, so bad cells never fail it."""
    texts = _read_csv_by_name(spark, path, schema.fieldNames())
    return coerce_strings(texts, schema, fill, date_formats)


def scan_month_files(
    spark: SparkSession, pattern: str, schema: T.StructType, name_pattern: str, by_path: bool = False
) -> DataFrame:
    """One file per month in one table; ``month`` comes from the file name.

    Files are matched by column name: their orders may differ, further columns are left
    out, and one that a file lacks is NULL. ``name_pattern`` is a regular expression with
    two groups, month name and year; ``by_path`` looks for it in the whole path.
    """
    name = F.col("_metadata.file_path" if by_path else "_metadata.file_name")
    text = F.concat_ws(
        " ",
        F.regexp_extract(name, name_pattern, 2),
        F.initcap(F.regexp_extract(name, name_pattern, 1)),
        F.lit("1"),
    )
    month = F.to_date(text, "yyyy MMMM d").alias("__month")
    table = _read_csv_by_name(spark, pattern, schema.fieldNames(), month)
    return table.select(
        F.col("__month").alias("month"), *(F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema)
    )


def _document_month(key: Column, year: int | None) -> Column:
    iso = F.when(key.rlike(r"^\d{4}-\d{2}$"), F.concat(key, F.lit("-01")).try_cast("date"))
    if year is None:
        return iso
    numbers = F.create_map(
        *(part for i, name in enumerate(MONTH_NAMES, 1) for part in (F.lit(name), F.lit(i)))
    )
    number = F.try_element_at(numbers, key)
    named = F.when(number.isNotNull(), F.make_date(F.lit(year), number, F.lit(1)))
    return F.coalesce(iso, named)


def inventory_explode(
    documents: DataFrame, text: str | None = None, year: int | None = None
) -> DataFrame:
    """Inventory documents ``{months: {key: {products: [...]}}}`` to snapshot rows.

    ``text`` names a JSON text column; without it the column ``months`` is taken as
    parsed. Keys are ``YYYY-MM``, or month names if ``year`` is given. Missing fields get
    the defaults of the document format: not at risk, no stock.
    """
    parsed = documents
    if text is not None:
        parsed = documents.select(
            F.from_json(text, schemas.INVENTORY_DOCUMENT).alias("__doc")
        ).select("__doc.months")
    products = (
        parsed.select(F.explode("months").alias("__key", "__month"))
        .select(_document_month(F.col("__key"), year).alias("month"), "__month.products")
        .select("month", F.inline("products"))
    )
    return _snapshot_rows(products)


def _snapshot_rows(products: DataFrame) -> DataFrame:
    """Products under the names of the snapshot table, with the defaults of the format."""
    return products.select(
        "month",
        "sku",
        F.col("productName").alias("product_name"),
        F.coalesce("qtyAvailable", F.lit(0)).alias("qty_available"),
        F.col("velocityMonthly").alias("velocity_monthly"),
        F.col("weeksOfSupply").alias("weeks_of_supply"),
        F.coalesce("atRisk", F.lit(False)).alias("at_risk"),
        F.col("riskLabel").alias("risk_label"),
    )


# Parts of a document's text, in order of trial. A flat object holds no other one.
_STRING = r'"(?:[^"\\\\]++|\\\\.)*+"'.replace("\\\\", "\\")
_FLAT = r"\{(?:[^\"{}]++|" + _STRING + r")*+\}"
_TOKEN = f"(?s){_STRING}\\s*+:\\s*+(?:{_FLAT}|\\{{)?|{_STRING}|{_FLAT}"
_OPENS = f"(?s)^({_STRING})\\s*+:\\s*+\\{{$"


def _object_start(spark: SparkSession, path: str) -> str | None:
    """The text with which the first product begins, up to and with its first quotation mark.

    It ends in an opening brace, white space and a quotation mark, which no place inside a
    string of the document can hold together with the name that follows.
    """
    pieces = [row.value for row in spark.read.text(path, lineSep='"').limit(64).collect()]
    for between, name in zip(pieces[::2], pieces[1::2], strict=False):
        if "[" in between and "{" in between.rpartition("[")[2]:
            return between[between.rindex("{") :] + f'"{name}"'
    return None


def _split_document(spark: SparkSession, path: str, year: int | None) -> DataFrame:
    """Snapshot rows of one file that holds one document, read by many tasks.

    The file is cut at the beginnings of products. Every record is taken apart into keys that
    open an object and into objects; the month is the last key that opened one, carried over
    from block to block by one row per block.
    """
    start = _object_start(spark, path)
    if start is None:
        reader, text = spark.read.option("wholetext", True), F.col("value")
    else:  # only what stands before the first product does not go on with a colon
        reader = spark.read.option("lineSep", start)
        text = F.when(F.col("value").rlike(r"^\s*:"), F.concat(F.lit(start), "value")).otherwise(F.col("value"))
    records = reader.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
        text.alias("text"),
    )
    tokens = records.select(
        "file", "block", "row", F.posexplode(F.regexp_extract_all("text", F.lit(_TOKEN), F.lit(0))).alias("at", "token")
    )
    opens = F.regexp_extract("token", _OPENS, 1)
    marked = tokens.select(
        "file", "block", "row", "at",
        F.when(opens != "", F.from_json(F.concat(F.lit("["), opens, F.lit("]")), "array<string>")[0]).alias("key"),
        F.when(F.col("token").startswith("{"), F.from_json("token", schemas.INVENTORY_PRODUCT)).alias("product"),
    )
    last = marked.groupBy("file", "block").agg(F.max_by("key", F.when(F.col("key").isNotNull(), F.struct("row", "at"))).alias("last"))
    before = last.select(
        F.col("file").alias("f"), F.col("block").alias("b"),
        F.last("last", ignorenulls=True).over(
            Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
        ).alias("earlier"),
    )
    inside = Window.partitionBy("file", "block").orderBy("row", "at").rowsBetween(Window.unboundedPreceding, 0)
    carried = marked.withColumn("own", F.last("key", ignorenulls=True).over(inside)).join(
        before, (F.col("file") == F.col("f")) & (F.col("block") == F.col("b"))
    )
    month = _document_month(F.coalesce("own", "earlier"), year)
    return _snapshot_rows(carried.where("product IS NOT NULL").select(month.alias("month"), "product.*"))


def read_inventory_documents(
    spark: SparkSession, path: str, year: int | None = None, multi_line: bool = False
) -> DataFrame:
    """Snapshot rows of inventory document files, one document per line.

    With ``multi_line`` each file is one document, however it is laid out, and is read in
    blocks by many tasks. Products must then be flat objects that begin with the same field,
    written the same way throughout, as one program writes them.
    """
    if multi_line:
        return _split_document(spark, path, year)
    documents = spark.read.schema(schemas.INVENTORY_DOCUMENT).json(path)
    return inventory_explode(documents, year=year)
