import datetime as dt

from shelfsight.operators import inventory as inv
from shelfsight.schemas import INVENTORY_SNAPSHOT

D = dt.date
MAY, JUNE = D(2025, 5, 1), D(2025, 6, 1)


def snapshot(spark, month, rows):
    """Rows of (sku, qty, weeks, at_risk)."""
    return spark.createDataFrame(
        [(month, sku, "name " + sku, qty, 1.0, weeks, risk, "Low") for sku, qty, weeks, risk in rows],
        INVENTORY_SNAPSHOT,
    )


def orders(spark, rows):
    return spark.createDataFrame(rows, "sku string, order_qty long, order_date date")


def test_categories_overlap_and_need_both_months(spark):
    prev = snapshot(spark, MAY, [
        ("fixed", 0, 1.0, True), ("stuck", 2, 1.0, True), ("out", 5, 9.0, False),
        ("dead", 0, None, None), ("gone", 5, 9.0, True),
    ])
    curr = snapshot(spark, JUNE, [
        ("fixed", 9, 9.0, False), ("stuck", 1, 0.5, True), ("out", 0, 0.0, True),
        ("dead", 0, None, False), ("new", 0, 0.0, True),
    ])
    bought = orders(spark, [("fixed", 12, D(2025, 6, 3)), ("new", 1, D(2025, 6, 4))])
    out = inv.inventory_transitions(prev, curr, bought)
    got = {}
    for r in out.collect():
        got.setdefault(r.sku, set()).add(r.category)
    assert got == {
        "fixed": {"at_risk_reordered", "oos_recovered", "improved"},
        "stuck": {"persistent_at_risk"},
        "out": {"new_at_risk", "new_oos"},
        "dead": {"persistent_oos"},
    }
    fixed = out.where("sku = 'fixed' AND category = 'improved'").first()
    assert (fixed.qty_change, fixed.order_qty, fixed.status_change) == (9, 12, "Resolved")
    counts = inv.transition_counts(out).first().asDict()
    assert counts == {**dict.fromkeys(inv.CATEGORIES, 1)}


def test_all_months_at_once_equal_single_pairs(spark):
    a = snapshot(spark, MAY, [("s", 0, 1.0, True)])
    b = snapshot(spark, JUNE, [("s", 5, 9.0, False)])
    none = orders(spark, [])
    monthly = none.selectExpr("*", "DATE '2025-06-01' AS month")
    both = inv.monthly_transitions(a.union(b), monthly)
    single = inv.inventory_transitions(a, b, none)
    assert {(r.month, r.sku, r.category) for r in both.collect()} == {
        (JUNE, r.sku, r.category) for r in single.collect()
    }


def test_topn_orders_by_risk_and_cover(spark):
    prev = snapshot(spark, MAY, [(f"s{i}", 3, 1.0, True) for i in range(4)])
    curr = snapshot(spark, JUNE, [
        ("s0", 3, 5.0, False), ("s1", 3, 2.0, True), ("s2", 3, None, True), ("s3", 3, 0.5, True),
    ])
    bought = orders(spark, [(f"s{i}", 1, JUNE) for i in range(4)])
    out = inv.inventory_transitions(prev, curr, bought)
    top = inv.transition_topn(out, {"at_risk_reordered": 3, "improved": None}).collect()
    ranked = sorted((r.rank, r.sku) for r in top if r.category == "at_risk_reordered")
    assert ranked == [(1, "s2"), (2, "s3"), (3, "s1")]
    assert [(r.sku, r.rank) for r in top if r.category == "improved"] == [("s0", None)]


def test_reorder_recency(spark):
    stock = snapshot(spark, JUNE, [
        (s, 1, w, True) for s, w in [("today", 1.0), ("d60", 1.0), ("d61", 2.0), ("never", 0.0)]
    ])
    lines = spark.createDataFrame(
        [("i1", D(2025, 8, 1), 5.0), ("i2", D(2025, 6, 2), 5.0), ("i3", D(2025, 6, 1), 5.0),
         ("i3", D(2025, 5, 1), 50.0), ("i9", D(2025, 8, 1), 5.0),
         ("i3", D(2025, 8, 2), 70.0)],  # placed after the as-of day
        "item_code string, doc_date date, quantity double",
    )
    mapping = spark.createDataFrame(
        [("i1", "today"), ("i2", "d60"), ("i3", "d61")], "item_code string, part_number string"
    )
    tracked = inv.reorder_tracking(stock, lines, mapping, D(2025, 8, 1))
    days = {r.sku: (r.days_since_order, r.last_order_qty) for r in tracked.collect()}
    assert days == {"today": (0, 5), "d60": (60, 5), "d61": (61, 5), "never": (None, None)}
    recent = {r.sku: r.has_recent_order for r in inv.reorder_recent(tracked).collect()}
    assert recent == {"today": True, "d60": True, "d61": False, "never": False}
    urgent = inv.reorder_attention(tracked, n=1).collect()
    assert [r.sku for r in urgent] == ["d61"]  # unknown cover sorts last
    latest = inv.reorder_recent_top(tracked, n=1).collect()
    assert [(r.sku, r.rank) for r in latest] == [("today", 1)]


def test_orders_fall_into_their_month_and_sku(spark):
    lines = spark.createDataFrame(
        [("a", D(2025, 6, 3), 5.5), ("b", D(2025, 6, 9), 1.0), ("a", D(2025, 7, 1), 2.0),
         ("unmapped", D(2025, 6, 3), 5.0)],
        "item_code string, doc_date date, quantity double",
    )
    mapping = spark.createDataFrame([("a", "s"), ("b", "s")], "item_code string, part_number string")
    got = {(r.sku, r.month): (r.order_qty, r.order_date)
           for r in inv.orders_by_sku(lines, mapping).collect()}
    assert got == {("s", JUNE): (6, D(2025, 6, 9)), ("s", D(2025, 7, 1)): (2, D(2025, 7, 1))}


def test_months_that_do_not_follow_each_other_are_no_transition(spark):
    rows = snapshot(spark, MAY, [("s", 0, 1.0, True)]).union(
        snapshot(spark, D(2025, 7, 1), [("s", 5, 9.0, False)])
    )
    monthly = orders(spark, []).selectExpr("*", "DATE '2025-06-01' AS month")
    assert inv.monthly_transitions(rows, monthly).count() == 0
