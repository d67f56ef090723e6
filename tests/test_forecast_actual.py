import datetime as dt
import random

from pyspark.sql import functions as F

from shelfsight.operators import forecast_actual as fa
from shelfsight.operators.ranking import running_totals

D = dt.date
JAN, FEB = D(2025, 1, 1), D(2025, 2, 1)


def forecast(spark, rows):
    return spark.createDataFrame(
        rows, "part_number string, item string, item_resolved boolean, description string,"
        " month date, forecast_qty double"
    )


def actuals(spark, rows):
    return spark.createDataFrame(
        rows, "item string, month date, actual_qty double, actual_revenue double"
    )


def test_month_and_january_columns():
    assert fa.month_columns(["item", "2025-01", "2025-12", "2025-1"]) == {
        "2025-01": JAN, "2025-12": D(2025, 12, 1)
    }
    assert fa.january_column(["Item", "2023-01-25 00:00:00", "Jan"], 2025) == "2023-01-25 00:00:00"
    assert fa.january_column(["Item", "25-Jan", "25-Feb"], 2025) == "25-Jan"
    assert fa.january_column(["Item", "01-25"], 2025) == "01-25"
    assert fa.january_column(["Item", "25-Feb"], 2025) is None


def test_unpivot_keeps_nulls_and_takes_labels(spark):
    wide = spark.createDataFrame([("p", 1.0, None)], "part string, `25-Jan` double, `25-Feb` double")
    rows = fa.forecast_unpivot(wide, {"25-Jan": JAN, "25-Feb": FEB}).orderBy("month").collect()
    assert [tuple(r) for r in rows] == [("p", JAN, 1.0), ("p", FEB, None)]


def test_mapping_last_line_wins_and_skips_blank(spark):
    catalog = spark.createDataFrame(
        [("p", "a", 1), ("p", " b ", 2), ("p", "nan", 3), ("q", " ", 4)],
        "part_number string, item_code string, line_no long",
    )
    rows = fa.sku_mapping(catalog, "part_number", "item_code").collect()
    assert [tuple(r) for r in rows] == [("p", "b")]


def test_forecast_keep_modes_and_unresolved(spark):
    fc = forecast(spark, [
        ("p1", "a", True, "x", JAN, 10.0),
        ("p2", "b", True, "x", JAN, 0.0),
        ("p3", "c", True, "x", JAN, None),
        ("p4", None, False, "x", JAN, 5.0),
    ])
    act = actuals(spark, [("a", JAN, 25.0, 100.0), ("b", JAN, 3.0, 30.0), ("p4", JAN, 9.0, 9.0)])
    kept = {r.part_number: r for r in fa.forecast_vs_actual(fc, act).collect()}
    assert set(kept) == {"p1", "p4"}
    assert (kept["p1"].variance_pct, kept["p1"].accuracy) == (150.0, 100.0)
    # an item code that happens to equal a part number must not match
    assert kept["p4"].actual_qty == 0.0
    any_ = {r.part_number: r for r in fa.forecast_vs_actual(fc, act, "any").collect()}
    assert set(any_) == {"p1", "p2", "p4"}
    assert (any_["p2"].variance_pct, any_["p2"].accuracy) == (0.0, 0.0)


def test_refresh_replaces_actuals(spark):
    fc = forecast(spark, [("p1", "a", True, "x", JAN, 10.0)])
    fva = fa.forecast_vs_actual(fc, actuals(spark, [("a", JAN, 25.0, 100.0)]))
    row = fa.fva_refresh(fva, actuals(spark, [("a", JAN, 5.0, 50.0)])).first()
    assert (row.actual_qty, row.variance, row.accuracy) == (5.0, -5.0, 50.0)
    assert fa.fva_refresh(fva, actuals(spark, [])).first().actual_qty == 0.0


def test_upsert_replaces_and_is_idempotent(spark):
    old = spark.createDataFrame([(JAN, 1), (FEB, 2), (None, 3)], "month date, v int")
    new = spark.createDataFrame([(FEB, 20, "n"), (D(2025, 3, 1), 30, "n")], "month date, v int, extra string")
    once = fa.month_upsert(old, new)
    assert {tuple(r) for r in once.collect()} == {
        (JAN, 1, None), (None, 3, None), (FEB, 20, "n"), (D(2025, 3, 1), 30, "n")
    }
    twice = fa.month_upsert(once, new)
    assert sorted(map(str, twice.collect())) == sorted(map(str, once.collect()))


def test_dashboard_pages_hold_everything_in_order(spark):
    rng = random.Random(3)
    rows = [(f"p{i:03d}", f"i{i:03d}", True, "x", m, float(rng.randint(1, 9)))
            for m in (JAN, FEB) for i in range(57)]
    fva = fa.forecast_vs_actual(forecast(spark, rows), actuals(spark, []))
    upcs = spark.createDataFrame([("i001", "000000000001")], "item_code string, upc_code string")
    documents = fa.fva_dashboard_month(fva, upcs, "online", page_size=10)
    assert {(r.page, len(r.products)) for r in documents.collect()} == {
        *((p, 10) for p in range(1, 6)), (6, 7)
    }
    products = fa.dashboard_products(documents).orderBy("month", "position").collect()
    for m in (JAN, FEB):
        got = [(p.position, p.item) for p in products if p.month == m]
        want = sorted((r for r in rows if r[4] == m), key=lambda r: (-r[5], r[1]))
        assert got == [(i, r[1]) for i, r in enumerate(want, 1)]


def test_running_totals_match_a_plain_window(spark):
    rng = random.Random(5)
    rows = [(rng.choice(["a", "b", None]), i, rng.randint(0, 5)) for i in range(2000)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, i int, v int")
    got = running_totals(df, [F.col("i").asc()], {"s": F.col("v"), "n": F.lit(1)}, by=["g"])
    want, sums = {}, {}
    for g, i, v in sorted(rows, key=lambda r: r[1]):
        s, n = sums.get(g, (0, 0))
        sums[g] = want[i] = (s + v, n + 1)
    assert {r.i: (r.s, r.n) for r in got.collect()} == want


def test_extremes_and_top_matched(spark):
    rows = [(f"p{i}", f"i{i}", True, "x", JAN, float(i)) for i in range(8)]
    fc = forecast(spark, rows)
    out = fa.forecast_extremes(fc, ["part_number"], 2, 2).collect()
    assert {(r.which, r.part_number) for r in out} == {
        ("top", "p7"), ("top", "p6"), ("bottom", "p1"), ("bottom", "p2")
    }
    fva = fa.forecast_vs_actual(fc, actuals(spark, [("i3", JAN, 9.0, 1.0), ("i4", JAN, 10.0, 1.0),
                                                    ("i5", JAN, 1.0, 1.0)]))
    top = fa.fva_top_matched(fva, JAN, 2).orderBy("rank").collect()
    assert [r.item for r in top] == ["i4", "i3"]


def test_dashboard_works_its_rows_out_once(spark, tmp_path):
    rows = [("p1", "i1", True, "x", JAN, 2.0), ("p2", "i2", True, "x", FEB, 3.0)]
    path = str(tmp_path / "fva")
    fa.forecast_vs_actual(forecast(spark, rows), actuals(spark, [])).write.parquet(path)
    upcs = spark.createDataFrame([("i1", "000000000001")], "item_code string, upc_code string")
    documents = fa.fva_dashboard_month(spark.read.parquet(path), upcs, "online")
    # order and totals read what was written, not the rows' own source again
    assert path not in documents._jdf.queryExecution().executedPlan().toString()
    assert {r.month: r.qty_products for r in documents.collect()} == {JAN: 1, FEB: 1}
