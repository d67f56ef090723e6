"""Both out-of-stock forms on histories whose runs were worked out by hand."""

import datetime as dt

from shelfsight.operators import oos
from shelfsight.schemas import INVENTORY_SNAPSHOT


def month(i):
    return dt.date(2024 + i // 12, i % 12 + 1, 1)


# item: quantities from month 0 on (None: no row), and its runs as start, back, months, volume
SALES = {
    "begins without": ([0, 4, 0, 0, 6], [(2, 4, 2, 2.0), (5, None, 3, 2.0)]),
    "still out": ([6, 6, 6, 0], [(3, None, 5, 6.0)]),
    "returns before": ([5, -2, 0, 3, 1, 1, 1, 1], [(2, 3, 1, 1.5)]),
    "returns inside": ([5, 0, -2, 0, 4, 1, 1, 1], [(1, 4, 3, 5.0)]),
    "only returns before": ([-3, 0, 4, 1, 1, 1, 1, 1], []),
    "three months back": ([9, 2, 3, 4, None, 0, 7, 7], [(4, 6, 2, 3.0)]),
    "twice": ([8, None, 2, None, 4, 4, 4, 4], [(1, 2, 1, 8.0), (3, 4, 1, 3.33)]),
    "never out": ([1] * 8, []),
}


def test_sales_form(spark):
    rows = [(item, month(i), float(v)) for item, (values, _) in SALES.items()
            for i, v in enumerate(values) if v is not None]
    sales = spark.createDataFrame(rows, "item string, month date, qty double").selectExpr(
        "item", "month", "CAST(qty AS DECIMAL(18,2)) AS qty"
    )
    got = {}
    for r in oos.oos_from_sales(sales, month(0), month(7)).collect():
        got.setdefault(r["item"], set()).add(
            (r.oos_start_month, r.back_in_stock_month, r.months_oos, r.avg_monthly_volume))
        assert r.status == ("Still OOS" if r.back_in_stock_month is None else "Restocked")
    for item, (_, runs) in SALES.items():
        want = {(month(s), b and month(b), n, v) for s, b, n, v in runs}
        assert got.get(item, set()) == want, item


def test_no_sales_no_runs(spark):
    empty = spark.createDataFrame([], "item string, month date, qty decimal(18,2)")
    assert oos.oos_from_sales(empty, None, None).count() == 0


# sku: (stock, velocity) from month 0 on (None: no row), and its runs as above
STOCK = {
    "plain": ([(5, 4.0), (0, 0.0), (0, None), (3, 1.0)], [(1, 3, 2, 4.0)]),
    "begins without": ([(0, 4.0), (5, 4.0), (5, 4.0)], []),
    "gap inside": ([(5, 2.0), (0, 1.0), None, (0, 1.0), (4, 1.0)], [(1, 4, 3, 2.0)]),
    "negative inside": ([(5, 2.0), (0, 1.0), (-3, 1.0), (1, 1.0)], [(1, 3, 2, 2.0)]),
    "negative is not out": ([(5, 2.0), (-3, 1.0), (5, 1.0)], []),
    "mean of the moving": ([(1, 9.0), (1, 2.0), (1, 0.0), (1, 6.0), (0, 0.0)], [(4, None, 2, 4.0)]),
    "gap before": ([(1, 9.0), None, None, None, (0, 3.0)], []),
    "never out": ([(1, 1.0)] * 6, []),  # so that all six months occur
}


def test_snapshot_form(spark):
    rows = [(month(i), sku, "n", cell[0], cell[1], None, False, "Low")
            for sku, (cells, _) in STOCK.items() for i, cell in enumerate(cells) if cell]
    got = {}
    for r in oos.oos_from_snapshots(spark.createDataFrame(rows, INVENTORY_SNAPSHOT)).collect():
        got.setdefault(r.sku, set()).add(
            (r.oos_start_month, r.back_in_stock_month, r.months_oos, r.avg_monthly_volume))
    for sku, (_, runs) in STOCK.items():
        want = {(month(s), b and month(b), n, v) for s, b, n, v in runs}
        assert got.get(sku, set()) == want, sku


def test_months_that_no_snapshot_has_do_not_count(spark):
    rows = [(month(i), "s", "n", q, 4.0, None, False, "Low") for i, q in [(0, 5), (3, 0), (7, 5)]]
    run = oos.oos_from_snapshots(spark.createDataFrame(rows, INVENTORY_SNAPSHOT)).first()
    assert (run.months_oos, run.lost_units, run.back_in_stock_month) == (1, 4.0, month(7))


def test_summary_and_top(spark):
    runs = spark.createDataFrame(
        [("a", month(0), "Still OOS", 5.25), ("b", month(0), "Restocked", 7.5),
         ("c", month(1), "Restocked", 7.5)],
        "item string, oos_start_month date, status string, lost_units double",
    )
    assert tuple(oos.oos_summary(runs).first()) == (3, 1, 2, 20.25)
    assert tuple(oos.oos_summary(runs.limit(0)).first()) == (0, 0, 0, 0.0)
    assert [r["item"] for r in oos.oos_top(runs, 2).collect()] == ["b", "c"]
