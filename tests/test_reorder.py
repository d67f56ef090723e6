import datetime as dt
import random
import re
import statistics

import pytest
from pyspark.sql import functions as F

from shelfsight.operators import reorder

D = dt.date
ASOF = D(2025, 7, 1)


def invoices(spark, days_by_account):
    rows = [("d", a, "s", day, 10.0, 1.0, "p", "r") for a, days in days_by_account.items() for day in days]
    return spark.createDataFrame(
        rows,
        "distributor string, account_id string, ship_to_code string, invoice_date date,"
        " revenue double, units double, product_name string, sales_rep string",
    )


def ago(*days):
    return [ASOF - dt.timedelta(days=d) for d in days]


def median_gap(days):
    days = sorted(days)
    gaps = [(b - a).days for a, b in zip(days, days[1:])]
    return float(statistics.median(gaps)) if gaps else 0.0


def test_paid_invoices_group_and_filter(spark):
    day = D(2025, 1, 1)
    rows = [
        ("d", "a", "s", day, 10.0, 1.0, "q", "r2"),
        ("d", "a", "s", day, -4.0, 1.0, "p", None),
        ("d", "b", "s", day, 5.0, 1.0, "p", "r1"),
        ("d", "b", "s", day, -5.0, 1.0, "p", "r1"),
        ("d", None, None, day, 3.0, None, None, "r1"),
        ("d", None, None, day, None, 2.0, "z", "r1"),
    ]
    lines = spark.createDataFrame(
        rows, "distributor string, canonical_code string, ship_to_code string, posting_date date,"
        " revenue double, quantity double, product_name string, sales_rep string",
    )
    got = {r.account_id: (r.revenue, r.units, r.product_name, r.sales_rep)
           for r in reorder.paid_invoices(lines).collect()}
    assert got == {"a": (6.0, 2.0, "p", "r2"), None: (3.0, 2.0, "z", "r1")}
    slim = reorder.paid_invoices(lines.drop("ship_to_code", "quantity", "sales_rep"))
    assert slim.columns == ["distributor", "account_id", "invoice_date", "revenue", "units", "product_name"]
    with pytest.raises(ValueError):
        reorder.paid_invoices(lines.drop("canonical_code"))


def test_asof_dates_start_on_or_after_the_lower_end():
    assert reorder.asof_dates("2025-01-02", "2025-03-01") == [D(2025, 2, 1), D(2025, 3, 1)]
    assert reorder.asof_dates("2025-01-01", "2025-01-01") == [D(2025, 1, 1)]
    assert reorder.asof_dates("2025-01-02", "2025-01-30") == []


def test_calendar_and_splits(spark):
    tx = spark.createDataFrame([(D(2025, 1, 15),), (D(2025, 10, 31),)], "posting_date date")
    days = [r.asof_date for r in reorder.asof_calendar(tx).orderBy("asof_date").collect()]
    assert days == [D(2025, m, 1) for m in range(2, 11)]
    short = spark.createDataFrame([(D(2025, 1, 15),), (D(2025, 1, 20),)], "posting_date date")
    assert reorder.asof_calendar(short).count() == 0
    s = reorder.split_calendar(tx, "2025-01-01").first()
    day = dt.timedelta(days=1)
    assert s.test_end == D(2025, 10, 31) and s.test_start == s.test_end - 60 * day
    assert s.valid_end == s.test_start - day and s.valid_start == s.valid_end - 45 * day
    assert s.train_end == s.valid_start - day and s.train_start == D(2025, 1, 1)


@pytest.mark.parametrize("asofs", [[ASOF], [D(2025, 6, 1), D(2025, 7, 1), D(2025, 8, 1)],
                                   [D(2025, 6, 15), D(2025, 6, 16), D(2025, 9, 30)]])
def test_features_against_a_plain_walk(spark, asofs):
    rng = random.Random(7)
    accounts = {
        f"a{k}": [D(2024, 9, 1) + dt.timedelta(days=rng.randint(0, 400) // rng.choice([1, 30]) * 1)
                  for _ in range(rng.randint(1, 14))]
        for k in range(60)
    }
    inv = invoices(spark, accounts)
    feats = {(r.account_id, r.asof_date): r for r in reorder.churn_features(inv, asofs).collect()}
    labels = {(r.account_id, r.asof_date): r for r in reorder.churn_labels(inv, asofs).collect()}
    latest = max(max(d) for d in accounts.values())
    expected = set()
    for asof in asofs:
        inside = lambda days, w: [d for d in days if asof - dt.timedelta(days=w) < d <= asof]
        any_gap = any(len(inside(days, 180)) > 1 for days in accounts.values())
        for a, days in accounts.items():
            past = sorted(d for d in days if d <= asof)
            if not past:
                continue
            expected.add((a, asof))
            f, w180 = feats[a, asof], inside(days, 180)
            assert f.days_since_last == (asof - past[-1]).days
            assert [f.orders_30d, f.orders_90d, f.orders_180d] == [
                len(inside(days, w)) for w in (30, 90, 180)]
            assert f.median_interval_180d == median_gap(w180)
            assert f.median_interval_90d == median_gap(inside(days, 90))
            recent = median_gap(past[-5:])
            assert f.median_interval_recent5 == (0.0 if any_gap and len(w180) < 2 else recent)
            horizon = asof + dt.timedelta(days=60)
            label = labels[a, asof]
            assert label.label == int(any(asof < d <= horizon for d in days))
            assert label.label_complete == (horizon <= latest)
    assert set(feats) == set(labels) == expected


def test_one_time_buyer_sentinel_follows_the_flags(spark):
    # one order in 180 days but a fast history: flagged by its cycle, then overwritten
    inv = invoices(spark, {"old": ago(175, 200, 210, 220, 230), "other": ago(10, 20)})
    loose = {r.account_id: r for r in reorder.churn_features(inv, [ASOF], strict_index=False).collect()}
    assert loose["old"].days_into_cycle == 999.0 and loose["old"].overdue_severity == 999.0
    assert loose["old"].is_severely_overdue == 1.0 and loose["old"].is_one_time_buyer == 1.0
    strict = {r.account_id: r for r in reorder.churn_features(inv, [ASOF]).collect()}
    assert strict["old"].median_interval_recent5 == 0.0
    assert strict["old"].is_severely_overdue == 0.0 and strict["old"].days_into_cycle == 999.0


def test_recent_median_survives_when_no_account_has_a_gap(spark):
    inv = invoices(spark, {"a": ago(200, 210, 230), "b": ago(5)})
    rows = {r.account_id: r.median_interval_recent5
            for r in reorder.reorder_intervals(inv, [ASOF]).collect()}
    assert rows == {"a": 15.0, "b": 0.0}


def test_label_edges(spark):
    inv = invoices(spark, {
        "on_asof": ago(30, 0), "at_horizon": ago(30) + ago(-60), "late": ago(30) + ago(-61),
        "future_only": ago(-5),
    })
    rows = {r.account_id: r.label for r in reorder.churn_labels(inv, [ASOF]).collect()}
    assert rows == {"on_asof": 0, "at_horizon": 1, "late": 0}


def test_breadth_skips_null_and_counts_each_once(spark):
    inv = invoices(spark, {"a": ago(5, 6, 100)}).withColumn(
        "product_name", F.when(F.col("invoice_date") == F.lit(ago(6)[0]), None).otherwise(F.lit("p"))
    )
    row = reorder.churn_window_features(inv, [ASOF]).first()
    assert (row.product_breadth_30d, row.product_breadth_180d) == (1, 1)
    assert (row.orders_30d, row.orders_180d, row.distributor_breadth_30d) == (2, 3, 1)


def test_feature_count():
    assert len(reorder.FEATURES) == len(set(reorder.FEATURES)) == 28


def test_windows_without_product_and_distributor_count_orders(spark):
    inv = invoices(spark, {"a": ago(5, 6, 100)}).drop("distributor", "product_name")
    row = reorder.churn_window_features(inv, [ASOF]).first()
    assert (row.orders_30d, row.product_breadth_30d, row.distributor_breadth_180d) == (2, 2, 3)
    assert row.revenue_180d == 30.0


def test_account_with_most_of_the_invoices(spark):
    busy = ago(1) * 3000 + ago(2) * 2000 + ago(40, 41, 43)
    inv = invoices(spark, {"busy": busy, "calm": ago(3, 13)})
    days = reorder._account_days(inv).where("account_id = 'busy'").count()
    assert days == 5  # what a window over the account has to hold
    rows = {r.account_id: r for r in reorder.churn_features(inv, [ASOF]).collect()}
    assert rows["busy"].orders_30d == 5000 and rows["busy"].orders_90d == 5003
    assert rows["busy"].median_interval_90d == 0.0 and rows["busy"].median_interval_recent5 == 0.0
    assert rows["calm"].median_interval_180d == 10.0


def test_an_invoice_is_not_repeated_for_its_dates(spark):
    asofs = reorder.asof_dates("2024-01-01", "2025-07-01")
    inv = invoices(spark, {"a": ago(5, 6, 100), "b": ago(30)})
    text = reorder._breadths(inv, asofs, ["distributor", "product_name"])
    plan = text._jdf.queryExecution().executedPlan().toString()
    # dates are listed above the last exchange, on a row per value
    assert plan.index("sequence(lo") < plan.index("Exchange hashpartitioning(account_id")
    state = reorder._asof_state(reorder.account_history(inv), asofs)
    assert "Exchange" not in state._jdf.queryExecution().executedPlan().toString()


def test_breadths_over_many_dates_and_stretches(spark):
    rng = random.Random(3)
    days = [D(2024, 1, 1) + dt.timedelta(days=k) for k in range(0, 400)]
    rows = [("d%d" % rng.randint(0, 1), f"a{rng.randint(0, 3)}", "s", rng.choice(days), 10.5, 1.0,
             rng.choice(["p", "q", "r", None]), "r") for _ in range(60)]
    inv = spark.createDataFrame(
        rows, "distributor string, account_id string, ship_to_code string, invoice_date date,"
        " revenue double, units double, product_name string, sales_rep string",
    )
    asofs = [D(2024, 1, 5) + dt.timedelta(days=3 * k) for k in range(190)]  # more than three numbers
    got = {(r.account_id, r.asof_date): r for r in reorder.churn_window_features(inv, asofs).collect()}
    seen = set()
    for asof in asofs:
        for account in ("a0", "a1", "a2", "a3"):
            for w in (30, 90, 180):
                inside = [r for r in rows if r[1] == account and 0 <= (asof - r[3]).days < w]
                if w == 180 and inside:
                    seen.add((account, asof))
                if (account, asof) in got:
                    r = got[account, asof]
                    assert r[f"product_breadth_{w}d"] == len({i[6] for i in inside} - {None})
                    assert r[f"distributor_breadth_{w}d"] == len({i[0] for i in inside})
                    assert r[f"orders_{w}d"] == len(inside)
                    assert r[f"revenue_{w}d"] == 10.5 * len(inside)
    assert set(got) == seen


def test_fewer_features_same_rows(spark):
    inv = invoices(spark, {"a": ago(5, 6, 100), "b": ago(30), "c": ago(200, 300)})
    few = ("orders_90d", "days_since_last")
    whole = reorder.churn_dataset(inv, [ASOF]).select("account_id", "asof_date", *few, "label", "label_complete")
    part = reorder.churn_dataset(inv, [ASOF], features=few)
    assert part.columns == whole.columns
    assert sorted(part.collect()) == sorted(whole.collect())
    assert "Exchange" not in part._jdf.queryExecution().executedPlan().toString().split("Subquery")[0]


def test_rows_per_account_and_date_do_not_move(spark):
    asofs = reorder.asof_dates("2024-01-01", "2025-07-01")
    inv = invoices(spark, {"a": ago(5, 6, 100), "b": ago(30)})
    for found in (reorder.churn_features(inv, asofs), reorder.churn_dataset(inv, asofs)):
        text = found._jdf.queryExecution().executedPlan().toString().split("Subquery")[0]
        assert "Exchange" not in text and "Join" not in text
    text = reorder.churn_window_features(inv, asofs)._jdf.queryExecution().executedPlan().toString()
    assert text.index("posexplode") < text.index("Join") < text.index("Exchange")
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text)
    assert len(keys) == 2 and all(re.fullmatch(r"account_id#\d+, \d+", key) for key in keys)


def test_only_the_invoices_needed_are_asked_for():
    assert reorder.invoice_columns() == ["account_id", "invoice_date"]
    assert reorder.invoice_columns(["orders_30d", "units_90d", "product_breadth_30d"]) == [
        "account_id", "invoice_date", "units", "product_name"]
    assert reorder.invoice_columns(reorder.FEATURES)[2:] == ["revenue", "units", "distributor", "product_name"]


def test_days_that_no_date_needs_are_not_written(spark):
    rng = random.Random(4)
    start = dt.date(2022, 1, 1)
    rows = [
        (f"a{rng.randint(0, 30)}", start + dt.timedelta(days=int(1400 * rng.random() ** 2)), 10.0, 1.0, f"p{rng.randint(0, 5)}", "d")
        for _ in range(900)
    ] + [(None, start, 5.0, 1.0, "p", "d"), ("a1", None, 5.0, 1.0, None, None)]
    columns = "account_id string, invoice_date date, revenue double, units double, product_name string, distributor string"
    inv = spark.createDataFrame([*rows, *rows[:50]], columns)
    asofs = [dt.date(2022, 2, 1), dt.date(2022, 11, 17), dt.date(2023, 7, 1), dt.date(2023, 8, 1)]
    whole = reorder.account_history(inv, breadths_at=asofs)
    for features in (reorder.FEATURES, ("orders_90d", "days_since_last"), ("median_interval_90d",)):
        for strict in (True, False):
            want = reorder._all_features(whole, asofs, strict, features).select(
                "account_id", "asof_date", *features,
                reorder._label(60).alias("label"), reorder._label_complete(whole, 60).alias("label_complete"),
            )
            got = reorder.churn_dataset(inv, asofs, 60, strict, features)
            assert got.schema.names == want.schema.names
            assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    few = reorder._history_for(inv, asofs, reorder.FEATURES)
    # at most a day per account and date, and its last one
    assert few.count() <= 31 * (len(asofs) + 1) < whole.count()
    latest = F.max("invoice_date")
    assert few.agg(latest).first() == whole.agg(latest).first()


def test_invoices_without_texts_are_summed_once(spark):
    columns = "distributor string, canonical_code string, posting_date date, revenue int, quantity int"
    day = dt.date(2025, 1, 1)
    lines = spark.createDataFrame([("d", "a", day, 1, None), ("d", "a", day, 2, 3), (None, None, day, 4, 1)], columns)
    lines = lines.withColumns({c: F.col(c).cast("decimal(18,2)") for c in ("revenue", "quantity")})
    got = reorder.paid_invoices(lines)
    text = got._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Aggregate [") == 1
    assert sorted(map(str, got.collect())) == sorted(map(str, reorder.paid_invoices(
        lines.withColumn("product_name", F.lit("p"))).drop("product_name").collect()))
    assert got.schema == reorder.paid_invoices(lines.withColumn("product_name", F.lit("p"))).drop("product_name").schema


def test_one_history_serves_tables_of_some_of_its_dates(spark):
    rng = random.Random(11)
    days = {f"a{i}": [D(2025, 1, 1) + dt.timedelta(days=rng.randrange(200)) for _ in range(rng.randrange(1, 12))]
            for i in range(30)}
    rows = [(f"d{j % 3}", a, "s", day, 10.0 + j, 1.0, f"p{j % 4}", "r") for a, ds in days.items() for j, day in enumerate(ds)]
    inv = spark.createDataFrame(rows, invoices(spark, {}).schema)
    training, valid, last = reorder.asof_dates("2025-02-01", "2025-05-01"), [D(2025, 6, 1)], [D(2025, 7, 18)]
    shared = reorder.shared_history(inv, [*training, *valid, *last])
    for dates in (training, valid, last):
        alone = reorder.churn_dataset(inv, dates)
        together = reorder.churn_dataset(inv, dates, history=shared)
        assert together.schema == alone.schema and alone.count() > 0
        assert sorted(together.collect()) == sorted(alone.collect())
        assert sorted(reorder.churn_features(inv, dates, history=shared).collect()) == sorted(
            reorder.churn_features(inv, dates).collect()
        )
    with pytest.raises(ValueError):
        reorder.churn_features(inv, [D(2025, 3, 2)], history=shared)
    with pytest.raises(ValueError):
        reorder.churn_dataset(inv, [], history=shared)
