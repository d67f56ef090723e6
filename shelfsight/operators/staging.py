"""Intermediate tables in the shared folder, so that a lost executor costs no recomputation."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; a temporary folder only for unset local runs."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="shelfsight-stage-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def importable(spark: SparkSession) -> None:
    """Let Python workers find this package where the driver did, from whatever folder it runs.

    On a cluster without a shared code folder, install the package or give it to ``--py-files``.
    """
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *paths])


def new_path(spark: SparkSession) -> str:
    """A path in the shared folder that goes when the driver's file system closes."""
    path = f"{shared_folder(spark).rstrip('/')}/stage-{uuid.uuid4().hex}"
    hadoop_path, fs = _file_system(spark, path)
    fs.deleteOnExit(hadoop_path)
    return path


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back (runs a job).

    The lineage ends there, so the job's shuffle files are removed with it. The files
    written go with ``discard`` or, at the latest, when the driver's file system closes.
    """
    spark = df.sparkSession
    path = new_path(spark)
    before = spark.conf.get(_CLEAN_UP)
    spark.conf.set(_CLEAN_UP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEAN_UP, before)
    staged = spark.read.schema(df.schema).parquet(path)
    staged._staged_path = path
    return staged


def discard(*staged: DataFrame) -> None:
    """Delete tables of ``stage`` that nothing will read any more."""
    for df in staged:
        path, fs = _file_system(df.sparkSession, df._staged_path)
        fs.delete(path, True)


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
