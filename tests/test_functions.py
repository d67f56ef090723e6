import pytest
from pyspark.sql import functions as F

from shelfsight.functions import (
    clean_token,
    growth_rate,
    round_half_up,
    to_number,
    upc_from_number,
    upc_from_sheet_text,
    upc_norm12,
    variance_metrics,
)


def apply(spark, expr, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("x"))).collect()]


def test_upc_norm12(spark):
    cases = {
        "7-10363-00000-7": "710363000007",
        "0710363000007": "710363000007",
        "1710363000007": "1710363000007",
        "00710363000007": "00710363000007",
        "abc": "000000000000",
        "": "000000000000",
        None: "000000000000",
        "42": "000000000042",
    }
    assert apply(spark, upc_norm12, list(cases)) == list(cases.values())


def test_upc_from_number(spark):
    values = ["710000000001.0", "1.05", "x", "", None, "7100000000012", "nan", "1e3", "5d"]
    assert apply(spark, upc_from_number, values) == [
        "710000000001", "000000000001", None, None, None, "7100000000012", None,
        "000000001000", None,
    ]


def test_upc_from_sheet_text(spark):
    values = ["710000000001.0", "1.05", "123"]
    assert apply(spark, upc_from_sheet_text, values) == [
        "710000000001", "000000001.05", "000000000123",
    ]
    everywhere = apply(spark, lambda c: upc_from_sheet_text(c, anywhere=True), values)
    assert everywhere == ["710000000001", "000000000015", "000000000123"]


def test_clean_token(spark):
    assert apply(spark, clean_token, [" a ", "", "  ", "nan", None]) == ["a", None, None, None, None]


def test_to_number(spark):
    values = ["1", " -2.5 ", ".5", "1e2", "abc", "", None, "12abc", "NaN", "1f"]
    assert apply(spark, to_number, values) == [1, -2.5, 0.5, 100, None, None, None, None, None, None]


def test_rounding_is_decimal(spark):
    assert apply(spark, lambda c: round_half_up(c, 2), [0.125, 1.005, -0.125], "double") == [
        0.13, 1.01, -0.13,
    ]


def test_growth_needs_positive_prior(spark):
    df = spark.createDataFrame([(3.0, 2.0), (3.0, 0.0), (3.0, -1.0), (3.0, None)], "a double, b double")
    got = [r[0] for r in df.select(growth_rate(F.col("a"), F.col("b"))).collect()]
    assert got == [0.5, None, None, None]


@pytest.mark.parametrize("zero, empty", [("null", None), ("zero", 0.0)])
def test_variance_metrics(spark, zero, empty):
    rows = [(72.0, 0.0), (10.0, 25.0), (10.0, -5.0), (0.0, 4.0)]
    df = spark.createDataFrame(rows, "f double, a double")
    metrics = variance_metrics(F.col("f"), F.col("a"), zero)
    got = [tuple(r) for r in df.select(*metrics.values()).collect()]
    assert got == [
        (-72.0, -100.0, 0.0), (15.0, 150.0, 100.0), (-15.0, -150.0, -50.0), (4.0, empty, empty),
    ]


def test_variance_rejects_unknown_mode():
    with pytest.raises(ValueError):
        variance_metrics(F, F, "other")
