import random

import numpy as np
import pytest

from shelfsight.operators import isotonic, models


def pool_adjacent(points):
    """The stack walk over (score, weight, y) in order; value per score."""
    stack = []
    for score, weight, y in sorted(points):
        stack.append([weight, y, [score]])
        while len(stack) > 1 and stack[-2][1] / stack[-2][0] >= stack[-1][1] / stack[-1][0]:
            weight, y, scores = stack.pop()
            stack[-1][0] += weight
            stack[-1][1] += y
            stack[-1][2] += scores
    return {s: y / w for w, y, scores in stack for s in scores}


def by_hand(rows):
    sums = {}
    for score, label, weight in rows:
        w, y = sums.get(score, (0, 0))
        sums[score] = (w + weight, y + weight * label)
    return pool_adjacent([(s, w, y) for s, (w, y) in sums.items()])


def fitted(spark, rows):
    df = spark.createDataFrame(rows, "score double, label double, weight double").repartition(5)
    got = isotonic.isotonic_fit(df, weight="weight").collect()
    assert len(got) == len({r[0] for r in rows})
    return {r.score: r.calibrated for r in got}


def made(kind, n=300):
    rng = random.Random(kind)
    if kind == "random":
        return [(rng.randint(0, 90) / 7, float(rng.randint(0, 1)), 1.0) for _ in range(n)]
    if kind == "nearly ordered":
        return [(float(i), (i + rng.choice([0, 0, 0, 3])) / 9, 1.0) for i in range(n)]
    if kind == "falling":
        return [(float(i), float(n - i), 1.0) for i in range(n)]
    if kind == "rising":
        return [(float(i), float(i * i), 1.0) for i in range(60)]
    if kind == "weights":
        return [(rng.random(), rng.random(), rng.choice([0.25, 1.0, 3.5])) for _ in range(n)]
    return [(0.5, float(i % 2), 1.0) for i in range(20)]


@pytest.mark.parametrize("kind", ["random", "nearly ordered", "falling", "rising", "weights", "one score"])
def test_same_as_pooling_in_order(spark, kind):
    rows = made(kind)
    assert fitted(spark, rows) == pytest.approx(by_hand(rows), abs=1e-9)


def test_rows_without_values_and_empty_tables(spark):
    schema = "score double, label int"
    df = spark.createDataFrame([(None, 1), (1.0, None), (2.0, 1)], schema)
    assert [tuple(r) for r in isotonic.isotonic_fit(df).collect()] == [(2.0, 1.0, 1.0)]
    assert isotonic.isotonic_fit(spark.createDataFrame([], schema)).collect() == []
    with pytest.raises(ValueError):
        models.fit_calibration(spark.createDataFrame([], schema), "score")


def test_calibration_is_straight_between_pools(spark):
    df = spark.createDataFrame([(0.0, 0), (1.0, 1), (2.0, 0), (4.0, 1)], "margin double, label int")
    calibration = models.fit_calibration(df)
    points = spark.createDataFrame([(x,) for x in (-5.0, 0.0, 0.5, 1.5, 3.0, 9.0)], "m double")
    got = points.select(calibration.apply(points.m).alias("c")).collect()
    assert np.allclose([r.c for r in got], [0.0, 0.0, 0.25, 0.5, 0.75, 1.0])
