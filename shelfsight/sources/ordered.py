"""Rows of text files in the order they stand there, across the part files of a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfsight.operators.ranking import running_totals


def with_place(df: DataFrame) -> DataFrame:
    """``df``, just read from files, with ``__part, __file, __block, __row``, which order its rows.

    Rows of one block are read by one task in their order. Part files count by number.
    """
    name = F.col("_metadata.file_name")
    return df.select(
        "*",
        F.coalesce(F.regexp_extract(name, r"part-(\d+)", 1).try_cast("long"), F.lit(-1)).alias("__part"),
        F.col("_metadata.file_path").alias("__file"),
        F.col("_metadata.file_block_start").alias("__block"),
        F.monotonically_increasing_id().alias("__row"),
    )


PLACE = ("__part", "__file", "__block", "__row")


def read_csv_in_order(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of a CSV folder with their ``position`` from 1, as its parts are read in order.

    Positions are running totals over range slices (runs jobs); nothing is sorted in the driver.
    """
    rows = with_place(spark.read.schema(schema).csv(path, header=True))
    counted = running_totals(rows, [F.col(c) for c in PLACE], {"position": F.lit(1)})
    return counted.select(*schema.names, F.col("position").cast("long").alias("position"))
