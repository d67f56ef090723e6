"""The shape of the physical plans."""

import re

import pytest

from shelfsight.operators import oos, reorder, sales
from shelfsight.plans.inputs import CURRENT, SALES_COLUMNS, read, transactions, transactions_sql, SNAPSHOT_SQL
from shelfsight.plans import QUERIES
from shelfsight.plans.reorder_queries import _invoices

TRAINED = {"churn_predictions", "feature_scaling", "calibration_fit"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - TRAINED))
def test_no_python_and_no_pairing(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert not re.search(r"Python|Pandas|CartesianProduct|BroadcastNestedLoopJoin", text)


def test_account_ranking_limits_before_the_shuffle(spark, sf_dir):
    df = sales.accounts_topn(transactions(spark, sf_dir, *SALES_COLUMNS, "canonical_code"), *CURRENT)
    text = plan(df)
    assert "WindowGroupLimit" in text and "Partial" in text


def test_top_products_is_a_top_k(spark, sf_dir):
    assert "TakeOrderedAndProject" in plan(QUERIES["top_skus_growth"](spark, sf_dir))


def test_summary_scans_only_its_columns(spark, sf_dir):
    text = plan(QUERIES["monthly_summary"](spark, sf_dir))
    scan = re.search(r"ReadSchema: struct<l_[^>]*", text).group()
    assert "l_tax" not in scan and "l_suppkey" not in scan
    assert "orders" not in text


def test_registered_summary_prunes_by_date(spark, sf_dir):
    text = plan(QUERIES["monthly_summary"](spark, sf_dir))
    assert "GreaterThanOrEqual(l_shipdate" in text and "LessThan(l_shipdate" in text


def test_growth_reads_the_lines_once(spark, sf_dir):
    assert plan(QUERIES["top_skus_growth"](spark, sf_dir)).count("lineitem.parquet") == 1


def test_date_range_reaches_the_scan(spark, tmp_path, sf_dir):
    path = str(tmp_path / "tx")
    transactions(spark, sf_dir).write.parquet(path)
    text = plan(sales.monthly_summary(spark.read.parquet(path), *CURRENT))
    assert "GreaterThanOrEqual(posting_date" in text and "LessThan(posting_date" in text


def test_sales_runs_need_one_shuffle_after_the_monthly_sums(spark):
    sales_rows = spark.createDataFrame([], "item string, month date, qty decimal(18,2)")
    text = plan(oos.oos_from_sales(sales_rows, "2025-01-01", "2025-12-01"))
    assert text.count("Exchange hashpartitioning") == 1


def test_accounts_are_ordered_once(spark, sf_dir):
    text = plan(reorder._account_days(_invoices(spark, sf_dir)))
    assert len(re.findall(r"\bWindow \[", text)) == 1
    assert text.count("lineitem.parquet") == 1
    # what follows reads the written days
    for name in ("churn_labels", "churn_features"):
        text = plan(QUERIES[name](spark, sf_dir))
        assert not re.search(r"\bWindow \[", text) and "lineitem" not in text


def test_invoices_are_sorted_once(spark, sf_dir):
    text = plan(_invoices(spark, sf_dir))
    assert len(re.findall(r"\bSort \[", text)) - text.count("SortMergeJoin") * 2 <= 1
    assert text.count("lineitem.parquet") == 1


def test_transitions_read_the_lines_twice(spark, sf_dir):
    for name in ("inventory_transitions", "transition_topn"):
        assert plan(QUERIES[name](spark, sf_dir)).count("lineitem.parquet") == 2


def test_forecast_fills_no_rows(spark, sf_dir):
    text = plan(QUERIES["sales_forecast"](spark, sf_dir))
    assert "posexplode" not in text


def test_months_may_be_given(spark, sf_dir):
    snapshot = read(spark, sf_dir, SNAPSHOT_SQL)
    months = spark.createDataFrame([], "month date, i int, n_months int")
    assert plan(oos.oos_from_snapshots(snapshot)).count("lineitem.parquet") == 2
    assert plan(oos.oos_from_snapshots(snapshot, months)).count("lineitem.parquet") == 1


def test_paid_invoices_combine_before_the_shuffle(spark, sf_dir):
    text = plan(_invoices(spark, sf_dir))
    below = text[text.rindex("Exchange hashpartitioning") :]
    lowest = [line for line in text.splitlines() if "Exchange" in line and "posting_date" in line][-1]
    under = text.splitlines()[text.splitlines().index(lowest) + 1]
    assert "HashAggregate" in under and "partial_sum" in under, below


def test_lines_meet_whole_orders(spark, sf_dir):
    columns = ("posting_date", "description", "canonical_code", "sales_rep", "quantity")
    text = transactions(spark, sf_dir, *columns)._jdf.queryExecution().optimizedPlan().toString()
    joins = re.findall(r"Join Inner, \((\w+)#", text)
    assert joins == ["p_partkey", "o_orderkey", "c_custkey"]  # from the top: customers are in the orders
    want = read(spark, sf_dir, transactions_sql(*columns))
    got = transactions(spark, sf_dir, *columns)
    assert got.columns == want.columns and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_model_evaluation_orders_accounts_once(spark, sf_dir, monkeypatch):
    written = []
    history = reorder.account_history
    monkeypatch.setattr(reorder, "account_history", lambda *a, **k: written.append(1) or history(*a, **k))
    QUERIES["model_evaluation"](spark, sf_dir)
    assert len(written) == 1
