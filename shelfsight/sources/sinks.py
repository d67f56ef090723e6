"""Writers. An order is asked for here, at the sink, and nowhere before."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _ordered(df: DataFrame, order_by: Sequence[str | Column]) -> DataFrame:
    # a range-partitioned sort: the part files, read in order, are sorted as a whole
    return df.orderBy(*order_by) if order_by else df


def write_csv(df: DataFrame, path: str, order_by: Sequence[str | Column] = ()) -> None:
    """CSV folder with a header in every part file."""
    _ordered(df, order_by).write.mode("overwrite").option("header", True).csv(path)


def write_documents(df: DataFrame, path: str, order_by: Sequence[str | Column] = ()) -> None:
    """One JSON object per row, NULL fields kept as null."""
    _ordered(df, order_by).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def overwrite_months(df: DataFrame, path: str, key: str = "month") -> None:
    """Replace exactly the months that ``df`` holds; other months stay untouched."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(key)
        .parquet(path)
    )


def describe_columns(df: DataFrame, descriptions: Mapping[str, str]) -> DataFrame:
    """Attach a description to columns, kept in the schema's metadata."""
    missing = set(descriptions) - set(df.columns)
    if missing:
        raise ValueError(f"no such columns: {sorted(missing)}")
    return df.select(
        *(
            F.col(f.name).alias(
                f.name, metadata={**f.metadata, "comment": descriptions[f.name]}
            )
            if f.name in descriptions
            else F.col(f.name)
            for f in df.schema
        )
    )


def output_dictionary(df: DataFrame) -> DataFrame:
    """Column names and descriptions of the described columns of ``df``."""
    rows = [(f.name, f.metadata["comment"]) for f in df.schema if "comment" in f.metadata]
    return df.sparkSession.createDataFrame(rows, "column STRING, description STRING")
