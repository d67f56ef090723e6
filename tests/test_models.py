import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from shelfsight.operators import models
from shelfsight.operators.reorder import FEATURES
from shelfsight.sources.sinks import output_dictionary


def metrics(spark, rows):
    r = models.rank_metrics(spark.createDataFrame(rows, "label int, score double")).first()
    return r.auc, r.pr_auc


def test_rank_metrics_by_hand(spark):
    assert metrics(spark, [(1, 0.9), (1, 0.8), (0, 0.2), (0, 0.1)]) == (1.0, 1.0)
    auc, ap = metrics(spark, [(0, 0.9), (0, 0.8), (1, 0.2), (1, 0.1)])
    assert auc == 0.0 and ap == pytest.approx((1 / 3 + 2 / 4) / 2)
    assert metrics(spark, [(1, 0.5), (0, 0.5), (1, 0.5), (0, 0.5)]) == (0.5, 0.5)
    assert metrics(spark, [(1, 0.5), (1, 0.4)]) == (None, None)
    assert metrics(spark, [(0, 0.5), (0, 0.4)]) == (None, None)


def test_rank_metrics_against_all_pairs(spark):
    rng = random.Random(2)
    rows = [(m, rng.randint(0, 1), rng.randint(0, 40) / 40) for m in ("x", "y") for _ in range(300)]
    df = spark.createDataFrame(rows, "model string, label int, score double")
    got = {r.model: (r.auc, r.pr_auc) for r in models.rank_metrics(df, by=["model"]).collect()}
    for m in ("x", "y"):
        pos = [s for k, y, s in rows if k == m and y]
        neg = [s for k, y, s in rows if k == m and not y]
        auc = sum((p > n) + (p == n) / 2 for p in pos for n in neg) / len(pos) / len(neg)
        ap = sum(sum(q >= p for q in pos) / (sum(q >= p for q in pos) + sum(n >= p for n in neg))
                 for p in pos) / len(pos)
        assert got[m] == (pytest.approx(auc), pytest.approx(ap))


def dataset(spark, n, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        label = rng.randint(0, 1)
        values = [rng.random() + (label if j < 2 else 0) for j in range(len(FEATURES))]
        rows.append((f"a{i}", dt.date(2025, 1, 1), *values, label))
    return spark.createDataFrame(rows, ["account_id", "asof_date", *FEATURES, "label"])


def test_train_choose_and_predict(spark):
    train, valid, test = (dataset(spark, n, s) for n, s in ((300, 1), (200, 2), (150, 3)))
    fitted = models.train_reorder_models(train, valid, FEATURES, num_trees=10, max_depth=5)
    assert fitted.best == max(fitted.validation, key=fitted.validation.get)
    assert all(0.8 < v <= 1 for v in fitted.validation.values())
    evaluated = models.evaluate_models(fitted, {"valid": valid, "test": test}).collect()
    assert {(r.model, r.split) for r in evaluated} == {
        (m, s) for m in ("logreg", "rf") for s in ("valid", "test")
    }
    assert all(r.auc > 0.8 for r in evaluated)
    out = models.churn_predictions(fitted, test.drop("label"), horizon=60)
    assert out.columns == [*models.DIAGNOSTICS, "risk_prob_reorder_60d"]
    span = out.agg(F.min(out.columns[-1]), F.max(out.columns[-1]), F.count("*")).first()
    assert 0 <= span[0] < span[1] <= 1 and span[2] == 150
    described = [r.column for r in output_dictionary(out).collect()]
    assert described == ["account_id", "asof_date", "risk_prob_reorder_60d"]
    for name in ("logreg", "rf"):
        assert models.score(fitted, test, name).where("score IS NULL").count() == 0


def test_one_class_cannot_be_trained(spark):
    df = dataset(spark, 20, 1).withColumn("label", F.lit(1))
    with pytest.raises(ValueError):
        models.train_reorder_models(df, df, FEATURES, num_trees=2, max_depth=2)


def test_the_certificate_tells_the_best_fit_from_others(spark):
    train = dataset(spark, 400, 5)
    scaler, logistic = models.fit_logistic(train, FEATURES)
    terms = models.logistic_optimality(train, FEATURES, scaler, logistic).collect()
    assert len(terms) == len(FEATURES) + 1
    assert max(abs(t.gradient) for t in terms) < 1e-5
    few = logistic.copy({logistic.regParam: 10.0})
    assert max(abs(t.gradient) for t in models.logistic_optimality(train, FEATURES, scaler, few).collect()) > 1e-2


def test_evaluation_chooses_by_the_chosen_split(spark):
    def part(rows):
        return spark.createDataFrame(rows, "label int, score double")

    good, bad = part([(1, 0.9), (0, 0.1)]), part([(1, 0.1), (0, 0.9)])
    one_class, empty = part([(1, 0.4)]), part([])

    def chosen(scored):
        return {(r.model, r.split): r.chosen for r in models.evaluate_scores(scored).collect()}

    assert chosen({("a", "valid"): bad, ("b", "valid"): good, ("a", "test"): good}) == {
        ("a", "valid"): False, ("b", "valid"): True, ("a", "test"): False
    }
    assert chosen({("b", "valid"): good, ("a", "valid"): good})["a", "valid"]
    assert chosen({("a", "valid"): one_class, ("b", "valid"): bad}) == {
        ("a", "valid"): False, ("b", "valid"): True
    }
    assert chosen({("a", "valid"): empty, ("b", "valid"): one_class}) == {("b", "valid"): True}
    assert chosen({("a", "test"): good}) == {("a", "test"): False}


def test_risk_order_puts_high_probabilities_first(spark):
    rows = [("b", 0.5), ("a", 0.5), ("c", 0.9), ("d", None)]
    df = spark.createDataFrame(rows, "account_id string, risk_prob_reorder_60d double")
    assert [r.account_id for r in df.orderBy(*models.risk_order()).collect()] == ["c", "a", "b", "d"]


def test_the_regression_needs_few_passes(spark):
    # features that say nearly the same thing
    rng = random.Random(9)
    rows = []
    for _ in range(2000):
        base, label = rng.gauss(0, 1), rng.randint(0, 1)
        rows.append((label, *((label + base) * (j + 1) + 0.001 * rng.gauss(0, 1) for j in range(6)), 5.0))
    names = [f"f{j}" for j in range(7)]
    train = spark.createDataFrame(rows, ["label", *names])
    context = spark.sparkContext
    context.setJobGroup("few-passes", "")
    try:
        scaler, logistic = models.fit_logistic(train, names)
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert len(context.statusTracker().getJobIdsForGroup("few-passes")) < 60
    terms = models.logistic_optimality(train, names, scaler, logistic).collect()
    assert max(abs(t.gradient) for t in terms) < 1e-8
    assert logistic.coefficients[6] == 0  # a feature without spread
    margins = models._with_margin(models.assembled(train, names), scaler, logistic).collect()
    row = margins[0]
    want = logistic.intercept + sum(
        c * row[n] / s for c, n, s in zip(logistic.coefficients, names, scaler.std) if s > 0
    )
    assert row.margin == pytest.approx(want) and "scaled" not in margins[0].asDict()


def test_the_regression_takes_separable_rows(spark):
    train = spark.createDataFrame([(int(i >= 10), 1000.0 * i) for i in range(20)], "label int, f double")
    scaler, logistic = models.fit_logistic(train, ["f"])
    terms = models.logistic_optimality(train, ["f"], scaler, logistic).collect()
    assert max(abs(t.gradient) for t in terms) < 1e-8 and logistic.coefficients[0] > 0
