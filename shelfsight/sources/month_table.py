"""A stored table by month whose upserts become visible at once or not at all.

The months of an upsert are written to a folder of their own. A manifest, a small JSON file
with a number, lists the folder of every current month; the one with the highest number is
the table. Writing a manifest under the next number is the switch: it is prepared under
another name and renamed, which fails if another writer took the number first. Until then
readers see the table as it was, and older manifests still describe older states.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_MANIFESTS, _DATA, _MONTH = "_manifests", "data", "__month"


class ConcurrentUpsert(RuntimeError):
    """Another writer finished between this one's start and its switch."""


def _path(spark: SparkSession, *parts: str):
    path = spark._jvm.org.apache.hadoop.fs.Path("/".join(parts))
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _names(spark: SparkSession, *parts: str) -> list[str]:
    path, fs = _path(spark, *parts)
    return [status.getPath().getName() for status in fs.listStatus(path)] if fs.exists(path) else []


def versions(spark: SparkSession, path: str) -> list[int]:
    """The numbers of the table's states, oldest first."""
    names = _names(spark, path, _MANIFESTS)
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))


def _manifest(spark: SparkSession, path: str, version: int) -> dict:
    file, fs = _path(spark, path, _MANIFESTS, f"{version:010d}.json")
    stream = fs.open(file)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def _switch(spark: SparkSession, path: str, version: int, manifest: dict) -> None:
    draft, fs = _path(spark, path, _MANIFESTS, f"{uuid.uuid4().hex}.draft")
    final, _ = _path(spark, path, _MANIFESTS, f"{version:010d}.json")
    stream = fs.create(draft, False)
    try:
        stream.write(bytearray(json.dumps(manifest).encode()))
    finally:
        stream.close()
    # a rename over a file may replace it on some stores, so the number is looked up first
    if fs.exists(final) or not fs.rename(draft, final):
        fs.delete(draft, False)
        raise ConcurrentUpsert(f"version {version} of {path} was written by another upsert")


def _merged(old: list[dict], new: list[dict]) -> list[dict]:
    known = {f["name"]: f for f in old}
    for field in new:
        before = known.setdefault(field["name"], field)
        if before["type"] != field["type"]:
            raise ValueError(f"column {field['name']} was {before['type']} and is {field['type']}")
    return list(known.values())


def upsert_months(df: DataFrame, path: str, key: str = "month") -> int:
    """Replace the months that ``df`` holds, keep all others; returns the new version's number.

    Columns that either side lacks are NULL there. Rows without a month replace those without
    a month, if ``df`` has any. Without rows nothing changes but the number. A failed write
    leaves only files that no manifest names. Months are few, so their list fits the driver.
    """
    spark = df.sparkSession
    seen = versions(spark, path)
    base = _manifest(spark, path, seen[-1]) if seen else {"months": {}, "fields": []}
    fields = _merged(base["fields"], [f.jsonValue() for f in df.schema])
    folder = uuid.uuid4().hex
    df.withColumn(_MONTH, F.col(key).cast("string")).write.partitionBy(_MONTH).parquet(f"{path}/{_DATA}/{folder}")
    written = [n.split("=", 1)[1] for n in _names(spark, path, _DATA, folder) if n.startswith(f"{_MONTH}=")]
    months = base["months"] | {month: folder for month in written}
    version = (seen[-1] if seen else 0) + 1
    _switch(spark, path, version, {"months": months, "fields": fields})
    return version


def read_months(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The table as it is now, or as it was at a version; one scan over the current folders."""
    seen = versions(spark, path)
    if not seen or (version is not None and version not in seen):
        raise FileNotFoundError(f"no such state of a month table at {path}")
    manifest = _manifest(spark, path, seen[-1] if version is None else version)
    schema = T.StructType.fromJson({"type": "struct", "fields": manifest["fields"]})
    folders = [f"{path}/{_DATA}/{folder}/{_MONTH}={month}" for month, folder in manifest["months"].items()]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*folders)


def remove_unlisted(spark: SparkSession, path: str, keep: int = 1) -> None:
    """Drop all but the last ``keep`` versions and the data that none of the kept ones names.

    Only while no upsert runs, since the data of one that has not switched yet is unlisted too.
    """
    seen = versions(spark, path)
    kept, old = seen[-keep:], seen[:-keep]
    named = {f for v in kept for f in _manifest(spark, path, v)["months"].values()}
    for version in old:
        file, fs = _path(spark, path, _MANIFESTS, f"{version:010d}.json")
        fs.delete(file, False)
    for folder in set(_names(spark, path, _DATA)) - named:
        unlisted, fs = _path(spark, path, _DATA, folder)
        fs.delete(unlisted, True)
