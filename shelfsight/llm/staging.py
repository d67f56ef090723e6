"""Intermediate tables in the shared folder, see ``shelfsight.operators.staging``, and batch sizes."""

from pyspark.sql import SparkSession

from shelfsight.operators.staging import discard, importable, shared_folder, stage

__all__ = ["discard", "importable", "shared_folder", "small_batches", "stage"]

#: Bytes of an Arrow batch of texts, about. Executor and Python worker hold it several times over.
BATCH_BYTES = 8 << 20
_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Hand texts to Python in small batches from now on, unless the session's are smaller."""
    now = spark.conf.get(_LIMIT).lower().removesuffix("b")
    if not now.lstrip("-").isdigit() or not 0 < int(now) <= BATCH_BYTES:
        spark.conf.set(_LIMIT, str(BATCH_BYTES))
