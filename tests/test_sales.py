import datetime as dt
from decimal import Decimal

from shelfsight import schemas
from shelfsight.operators import sales

D = dt.date
CY, PY = ("2025-01-01", "2026-01-01"), ("2024-01-01", "2025-01-01")


def tx(spark, rows):
    """Rows of (day, name, code, account, quantity, revenue, amount)."""
    full = [
        (day, name, code, None, "d", "r", account, None, None, qty and Decimal(qty),
         rev and Decimal(rev), amount and Decimal(amount), None)
        for day, name, code, account, qty, rev, amount in rows
    ]
    return spark.createDataFrame(full, schemas.TRANSACTIONS)


def test_range_is_half_open_and_revenue_falls_back(spark):
    df = tx(spark, [
        (D(2024, 12, 31), "a", "1", "x", "1", "5", "9"),
        (D(2025, 1, 1), "a", "1", "x", "1", None, "9"),
        (D(2025, 12, 31), "a", "1", "x", "1", "5", "9"),
        (D(2026, 1, 1), "a", "1", "x", "1", "5", "9"),
    ])
    rows = sales.monthly_summary(df, *CY).orderBy("month").collect()
    assert [(r.month, float(r.revenue), r.txn_count) for r in rows] == [
        (D(2025, 1, 1), 9.0, 1), (D(2025, 12, 1), 5.0, 1),
    ]


def test_accounts_null_revenue_first_and_ties_by_account(spark):
    day = D(2025, 5, 1)
    df = tx(spark, [
        (day, "a", "1", "z", "1", "5", "5"),
        (day, "a", "1", "y", "1", "5", "5"),
        (day, "a", "1", "n", "1", None, None),
        (day, "a", "1", None, "1", "5", "5"),
    ])
    rows = sales.accounts_topn(df, *CY, n=3).orderBy("rank").collect()
    assert [r.canonical_code for r in rows] == ["n", "y", "z"]


def test_names_by_frequency_then_alphabet_and_null_last(spark):
    day = D(2025, 5, 1)
    df = tx(spark, [
        (day, n, c, "x", "1", "5", "5")
        for n, c in [("b", "1"), ("a", "1"), ("b", "2"), ("b", "2"), ("a", "2"),
                     (None, "3"), ("c", "3"), (None, "4")]
    ])
    rows = {r.upc_norm12[-1]: r.sku_name for r in sales.sku_names(df, *CY).collect()}
    assert rows == {"1": "a", "2": "b", "3": "c", "4": None}


def test_growth_keeps_unknown_codes_unless_asked(spark):
    df = tx(spark, [
        (D(2025, 5, 1), "junk", "abc", "x", "1", "50", "5"),
        (D(2024, 5, 1), "junk", None, "x", "1", "25", "5"),
        (D(2025, 5, 1), "real", "12", "x", "2", "20", "5"),
        (D(2024, 5, 1), "gone", "13", "x", "2", "20", "5"),
    ])
    rows = sales.top_skus_growth(df, CY[0], None, *PY).collect()
    assert [(r.sku_name, r.growth_rate) for r in rows] == [("junk", 1.0), ("real", None)]
    known = sales.top_skus_growth(df, CY[0], None, *PY, exclude_unknown=True).collect()
    assert [r.sku_name for r in known] == ["real"]


def test_summaries_share_one_grand_total(spark, sf_dir):
    from shelfsight.plans.inputs import transactions

    df = transactions(spark, sf_dir)
    makers = (sales.monthly_summary, sales.distributor_summary, sales.salesrep_summary,
              sales.account_summary)
    totals = set()
    for make in makers:
        out = make(df, *CY[:0], "2000-01-01", "2001-01-01")
        revenue = "revenue" if "revenue" in out.columns else "revenue_ytd"
        totals.add(out.agg({revenue: "sum", "txn_count": "sum"}).first()[:])
    assert len(totals) == 1


def test_unsold_launches_stay(spark):
    df = tx(spark, [(D(2025, 5, 1), "a", "7-10363-00000-7", "x", "1", "50", "5")])
    launches = spark.createDataFrame(
        [("sold", "7-10363-00000-7"), ("unsold", "9-99999-99999-9")], schemas.LAUNCH_LIST
    )
    rows = {r.sku_name: (float(r.ytd_revenue), r.growth_rate)
            for r in sales.launch_performance(df, launches, CY[0], None, *PY).collect()}
    assert rows == {"sold": (50.0, None), "unsold": (0.0, None)}
    assert sales.launch_transactions(df, launches, *CY).count() == 1
