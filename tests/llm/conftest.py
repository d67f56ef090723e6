import pytest
from pyspark.sql import types as T

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars int"


@pytest.fixture
def documents(spark):
    """Documents from texts, or from (doc_id, text) or (doc_id, text, source)."""

    def make(rows, extra=None):
        full = []
        for i, row in enumerate(rows):
            if row is None or isinstance(row, str):
                row = (i, row)
            doc_id, text, *source = row
            full.append((doc_id, text, "en", source[0] if source else "s", len(text or "")))
        schema = T.StructType.fromDDL(DOCUMENTS)
        docs = spark.createDataFrame(full, schema)
        return docs.selectExpr("*", *extra) if extra else docs

    return make


def numbers(n, seed):
    """Repeatable words that no other seed shares."""
    return " ".join(f"w{seed}x{i * 7919 % 100003}" for i in range(n))


@pytest.fixture
def made():
    return numbers
