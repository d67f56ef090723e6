"""Reorder probability: two models, calibration, choice by average precision."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml.feature import StandardScaler, StandardScalerModel, VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfsight.operators import forest as forests
from shelfsight.operators import logistic as regressions
from shelfsight.operators.isotonic import isotonic_fit, pools
from shelfsight.operators.ranking import running_totals
from shelfsight.operators.staging import stage
from shelfsight.sources.sinks import describe_columns

DIAGNOSTICS = (
    "account_id",
    "asof_date",
    "days_since_last",
    "median_interval_recent5",
    "median_interval_180d",
    "days_into_cycle",
    "velocity_trend",
    "orders_30d",
    "orders_90d",
    "orders_180d",
    "is_severely_overdue",
    "is_high_frequency",
)
#: The split whose average precision chooses the model.
CHOOSING = "valid"
# What a reader of the predictions needs to know about them.
DESCRIPTIONS = {
    "account_id": "Account the prediction is for",
    "asof_date": "Day up to which data was used",
}


def rank_metrics(
    scored: DataFrame, label: str = "label", score: str = "score", by: Sequence[str] = ()
) -> DataFrame:
    """ROC-AUC and average precision, ties counted half; NULL with a single class.

    Rows are first counted per score, then summed along the falling scores without
    putting them all into one task (runs a job, see ``running_totals``).
    """
    tied = scored.groupBy(*by, F.col(score).alias("score")).agg(
        F.sum(F.col(label).cast("bigint")).alias("pos"),
        F.sum(1 - F.col(label).cast("bigint")).alias("neg"),
    )
    ranked = running_totals(
        tied, [F.col("score").desc()], {"tp": F.col("pos"), "fp": F.col("neg")}, by=by
    )
    pos, neg, tp, fp = (F.col(c).cast("double") for c in ("pos", "neg", "tp", "fp"))
    positives, negatives = F.sum("pos"), F.sum("neg")
    both = (positives > 0) & (negatives > 0)
    return ranked.groupBy(*by).agg(
        positives.alias("positives"),
        negatives.alias("negatives"),
        F.when(
            both,
            1
            - F.sum(pos * (fp - neg / 2))
            / (positives.cast("double") * negatives.cast("double")),
        ).alias("auc"),
        F.when(both, F.sum(pos * (tp / (tp + fp))) / positives.cast("double")).alias("pr_auc"),
    )


@dataclass(frozen=True)
class Calibration:
    """A non-decreasing step fit: straight between its pools, level beyond them."""

    scores: np.ndarray
    values: np.ndarray

    def apply(self, score: Column) -> Column:
        scores, values = self.scores, self.values

        @F.pandas_udf("double")
        def calibrated(column: pd.Series) -> pd.Series:
            return pd.Series(np.interp(column.to_numpy(float), scores, values))

        return calibrated(score)


@dataclass(frozen=True)
class ReorderModels:
    features: tuple[str, ...]
    scaler: StandardScalerModel
    logistic: regressions.LogisticFit
    calibration: Calibration
    forest: forests.Forest
    validation: dict[str, float | None]  # average precision per model
    best: str


def assembled(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """The features as one vector, ``raw``."""
    return VectorAssembler(inputCols=list(features), outputCol="raw").transform(df)


def _with_margin(df: DataFrame, scaler, logistic) -> DataFrame:
    """The logistic model's log odds."""
    return logistic.transform(scaler.transform(df)).drop("scaled")


def _logistic_scores(df: DataFrame, scaler, logistic, calibration) -> DataFrame:
    scored = _with_margin(df, scaler, logistic)
    return scored.withColumn("score", calibration.apply(F.col("margin"))).drop("margin")


def class_weights(train: DataFrame) -> dict[int, float]:
    """Weights that give both labels half of the total, from one aggregate."""
    return _class_weights(train)[0]


def _class_weights(train: DataFrame) -> tuple[dict[int, float], int]:
    """``class_weights`` and the number of rows."""
    positives, total = train.agg(F.count_if(F.col("label") == 1), F.count(F.lit(1))).first()
    if not 0 < positives < total:
        raise ValueError(f"training needs both labels, found {positives} of {total} rows with 1")
    return {0: total / (2.0 * (total - positives)), 1: total / (2.0 * positives)}, total


def fit_scaler(rows: DataFrame) -> StandardScalerModel:
    """Standard deviations of the features in ``raw``; means are left as they are."""
    scaler = StandardScaler(inputCol="raw", outputCol="scaled", withMean=False, withStd=True)
    return scaler.fit(rows)


def fit_calibration(scored: DataFrame, score: str = "margin") -> Calibration:
    """Isotonic fit of label on a score (runs jobs).

    Only the pools of the finished fit reach the driver. Their means are rising fractions whose
    denominators add up to the number of rows, so n rows have some n ** (2 / 3) pools at most.
    """
    rows = pools(isotonic_fit(scored, score)).orderBy("low").collect()
    ends = [(at, row.calibrated) for row in rows for at in sorted({row.low, row.high})]
    if not ends:
        raise ValueError("calibration needs scored rows with labels")
    return Calibration(*np.array(ends).T)


def fit_logistic(
    train: DataFrame, features: Sequence[str]
) -> tuple[StandardScalerModel, regressions.LogisticFit]:
    """Logistic regression with balanced labels and a penalty of half the squared coefficients.

    The penalty weighs as much as one row, so its share falls with the number of rows. The rows
    are read once per step, some ten times, and should be staged.
    """
    weights, total = _class_weights(train)
    scaler = fit_scaler(assembled(train, features))
    logistic = regressions.fit(
        train, [F.col(f) for f in features], list(scaler.std), F.col("label"), _weight(weights), 1.0 / total
    )
    return scaler, logistic


def _weight(weights: dict[int, float]) -> Column:
    return F.when(F.col("label") == 1, weights[1]).otherwise(weights[0])


def logistic_optimality(
    train: DataFrame,
    features: Sequence[str],
    scaler: StandardScalerModel,
    logistic: regressions.LogisticFit,
) -> DataFrame:
    """``term, coefficient, observed, gradient``: how far the fit is from the best one.

    The loss is convex, so the fit is the best exactly if its gradient is 0 in every term:
    the weighted mean of (probability - label) times the scaled feature, plus the penalty's
    part. ``observed`` is the weighted mean of label times scaled feature, which does not
    depend on the fit. One aggregate over the rows, from the features themselves.
    """
    weight = _weight(class_weights(train))
    penalty = logistic.getRegParam()
    spread = [float(v) for v in scaler.std]
    factors = [float(v) for v in logistic.coefficients]
    terms = [
        ("(intercept)", float(logistic.intercept), F.lit(1.0), 0.0),
        *((f, c, F.col(f) / s if s > 0 else F.lit(0.0), penalty * c)
          for f, c, s in zip(features, factors, spread, strict=True)),
    ]
    margin = sum((F.lit(c) * x for _, c, x, _ in terms[1:]), F.lit(terms[0][1]))
    rows = train.select(
        weight.alias("w"), F.col("label").cast("double").alias("y"),
        (1 / (1 + F.exp(-margin))).alias("p"), *(x.alias(f"x{i}") for i, (_, _, x, _) in enumerate(terms)),
    )
    total = F.sum("w")
    sums = rows.agg(
        *(F.struct(
            F.lit(name).alias("term"), F.lit(c).alias("coefficient"),
            (F.sum(F.col("w") * F.col("y") * F.col(f"x{i}")) / total).alias("observed"),
            (F.sum(F.col("w") * (F.col("p") - F.col("y")) * F.col(f"x{i}")) / total + own).alias("gradient"),
        ).alias(f"t{i}") for i, (name, c, _, own) in enumerate(terms))
    )
    return sums.select(F.inline(F.array(*(F.col(f"t{i}") for i in range(len(terms))))))


def row_key(rows: DataFrame) -> Column:
    """What tells training rows apart: account and as-of date, or their place if they have none."""
    if {"account_id", "asof_date"} <= set(rows.columns):
        return F.concat_ws("|", "account_id", "asof_date")
    return F.monotonically_increasing_id().cast("string")


def train_reorder_models(
    train: DataFrame,
    valid: DataFrame,
    features: Sequence[str],
    seed: int = 42,
    num_trees: int = 400,
    max_depth: int = 15,
) -> ReorderModels:
    """Fit both models on ``train``, calibrate and choose on ``valid`` (runs jobs).

    The inputs are written out once, since every iteration reads them again. The forest has
    the published settings: class weights of each tree's own sample, no split below five rows,
    two rows on each side at least. Only its depth is limited, because a forest without a limit
    grows with the rows.

    The choice by average precision reads the same rows that calibrated the logistic model,
    so it flatters that model a little, as the published choice does.
    """
    columns = [*features, "label"]
    train = stage(train.select(*columns, row_key(train).alias("row_key")))
    valid = stage(valid.select(columns))

    scaler, logistic = fit_logistic(train, features)
    checked = assembled(valid, features)
    calibration = fit_calibration(_with_margin(checked, scaler, logistic))

    forest = forests.fit_forest(
        train, features, F.col("row_key"), num_trees=num_trees, max_depth=max_depth, seed=seed
    )

    evaluation = evaluate_scores(
        {
            ("logreg", CHOOSING): _logistic_scores(checked, scaler, logistic, calibration),
            ("rf", CHOOSING): forests.score(forest, checked),
        }
    ).collect()
    validation = {row.model: row.pr_auc for row in evaluation}
    best = next(row.model for row in evaluation if row.chosen)
    return ReorderModels(
        tuple(features), scaler, logistic, calibration, forest, validation, best
    )


def evaluate_scores(scored: dict[tuple[str, str], DataFrame]) -> DataFrame:
    """``model, split, positives, negatives, auc, pr_auc, chosen`` of scored and labelled rows.

    Keys are (model, split). All parts are ranked together, by model and split. Chosen is the
    model with the best average precision on the split CHOOSING: one that has none comes last,
    and of equal ones the first by name. A part without rows has no line.
    """
    parts = [
        df.select(F.lit(model).alias("model"), F.lit(split).alias("split"), "label", "score")
        for (model, split), df in scored.items()
    ]
    metrics = rank_metrics(reduce(DataFrame.unionByName, parts), by=["model", "split"])
    order = F.struct((-F.coalesce("pr_auc", F.lit(-1.0))).alias("o"), F.col("model").alias("m"))
    best = F.min(F.when(F.col("split") == CHOOSING, order)).over(Window.partitionBy(F.lit(0)))
    return metrics.select(
        "model", "split", "positives", "negatives", "auc", "pr_auc",
        F.coalesce(F.col("model") == best["m"], F.lit(False)).alias("chosen"),
    )


def score(models: ReorderModels, df: DataFrame, model: str | None = None) -> DataFrame:
    """``df`` with ``score``, the probability of a reorder, by the best or a named model."""
    ready = assembled(df, models.features)
    name = model or models.best
    if name == "logreg":
        scored = _logistic_scores(ready, models.scaler, models.logistic, models.calibration)
    elif name == "rf":
        scored = forests.score(models.forest, ready)
    else:
        raise ValueError(f"unknown model {name!r}")
    return scored.drop("raw")


def evaluate_models(models: ReorderModels, splits: dict[str, DataFrame]) -> DataFrame:
    """AUC and average precision of both models per split, see ``evaluate_scores``."""
    return evaluate_scores(
        {(name, split): score(models, df, name) for split, df in splits.items() for name in ("logreg", "rf")}
    )


def risk_order(horizon: int = 60) -> list[Column]:
    """The order of the risk list: falling probability, then account."""
    return [F.col(f"risk_prob_reorder_{horizon}d").desc_nulls_last(), F.col("account_id").asc_nulls_first()]


def churn_predictions(models: ReorderModels, latest: DataFrame, horizon: int = 60) -> DataFrame:
    """Diagnostics and reorder probability per account. Sort at the sink, by ``risk_order``.

    The name of the last column says risk, but it is the probability that the account
    does order again.
    """
    probability = f"risk_prob_reorder_{horizon}d"
    predictions = score(models, latest).select(*DIAGNOSTICS, F.col("score").alias(probability))
    meaning = f"Probability of at least one paid invoice in the {horizon} days after that day"
    return describe_columns(predictions, {**DESCRIPTIONS, probability: meaning})
