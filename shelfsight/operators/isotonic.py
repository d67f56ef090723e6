"""Isotonic regression without putting the points in one place.

The fit is the slope of the greatest convex minorant of the cumulative diagram: points
(total weight, total label) along the rising scores. Its corners are found by recursive
partition: of the points between two corners, the one furthest below their chord is a corner
too, and points on or above the chord are none. All stretches are worked on at once, so a
round is one aggregate by stretch that combines before the shuffle, and the totals themselves
are summed only once, in range slices.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfsight.operators.ranking import running_totals
from shelfsight.operators.staging import discard, stage

_STRETCH = ["low_w", "low_y", "high_w", "high_y"]


def cumulative_diagram(
    scored: DataFrame, score: str = "score", label: str = "label", weight: str | None = None
) -> DataFrame:
    """``score, weight, y, total_w, total_y``: equal scores taken together, totals included."""
    w = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    points = (
        scored.where(F.col(score).isNotNull() & F.col(label).isNotNull())
        .groupBy(F.col(score).cast("double").alias("score"))
        .agg(F.sum(w).alias("weight"), F.sum(w * F.col(label)).alias("y"))
        .where("weight > 0")
    )
    totals = {"total_w": F.col("weight"), "total_y": F.col("y")}
    return running_totals(points, [F.col("score")], totals)


def _corners(diagram: DataFrame) -> DataFrame:
    """``low_w, low_y, high_w, high_y``: the stretches of the convex minorant (runs jobs)."""
    ends = diagram.agg(F.max("total_w").alias("w"), F.max_by("total_y", "total_w").alias("y")).first()
    spark = diagram.sparkSession
    if ends.w is None:
        return spark.createDataFrame([], "low_w double, low_y double, high_w double, high_y double")
    here = [F.lit(v).alias(c) for v, c in zip((0.0, 0.0, ends.w, ends.y), _STRETCH, strict=True)]
    # the last point ends the first chord and is no candidate
    points = diagram.where(F.col("total_w") < ends.w).select("total_w", "total_y", *here)
    settled, staged = [], []
    stretches = spark.range(1).select(*here)
    while True:
        # twice the area between chord and point; below the chord is negative
        below = (F.col("total_y") - F.col("low_y")) * (F.col("high_w") - F.col("low_w")) - (
            F.col("high_y") - F.col("low_y")
        ) * (F.col("total_w") - F.col("low_w"))
        under = stage(points.withColumn("below", below).where("below < 0"))
        staged.append(under)
        lowest = stage(
            under.groupBy(*_STRETCH)
            .agg(F.min(F.struct("below", "total_w", "total_y")).alias("corner"))
            .select(*_STRETCH, F.col("corner.total_w").alias("cut_w"), F.col("corner.total_y").alias("cut_y"))
        )
        staged.append(lowest)
        split = stretches.join(lowest, _STRETCH, "left")
        settled.append(split.where("cut_w IS NULL").select(*_STRETCH))
        if lowest.isEmpty():
            break
        halves = [("low_w", "low_y", "cut_w", "cut_y"), ("cut_w", "cut_y", "high_w", "high_y")]
        parts = [lowest.select(*(F.col(a).alias(b) for a, b in zip(h, _STRETCH, strict=True))) for h in halves]
        stretches = parts[0].unionByName(parts[1])
        left = F.col("total_w") < F.col("cut_w")
        points = under.join(lowest, _STRETCH).where("total_w != cut_w").select(
            "total_w", "total_y",
            F.when(left, F.col("low_w")).otherwise(F.col("cut_w")).alias("low_w"),
            F.when(left, F.col("low_y")).otherwise(F.col("cut_y")).alias("low_y"),
            F.when(left, F.col("cut_w")).otherwise(F.col("high_w")).alias("high_w"),
            F.when(left, F.col("cut_y")).otherwise(F.col("high_y")).alias("high_y"),
        )
    out = settled[0]
    for part in settled[1:]:
        out = out.unionByName(part)
    out = stage(out)
    discard(*staged)
    return out


def isotonic_fit(
    scored: DataFrame, score: str = "score", label: str = "label", weight: str | None = None
) -> DataFrame:
    """``score, weight, calibrated``: the best non-decreasing fit of the label, per distinct score.

    Rows without score or label, or without weight, play no part; no rows give no rows. The
    number of rounds is the depth of the partition, about the logarithm of the number of
    pools. Runs jobs.
    """
    diagram = stage(cumulative_diagram(scored, score, label, weight))
    slope = (F.col("high_y") - F.col("low_y")) / (F.col("high_w") - F.col("low_w"))
    # ends of stretches and points meet in one order; a point lies in the next stretch to end
    ends = _corners(diagram).select(
        F.col("high_w").alias("at"), F.struct(F.col("high_w").alias("w"), slope.alias("v")).alias("pool"),
        F.lit(None).cast("struct<score:double,weight:double>").alias("point"),
    )
    points = diagram.select(
        F.col("total_w").alias("at"), F.lit(None).cast("struct<w:double,v:double>").alias("pool"),
        F.struct("score", "weight").alias("point"),
    )
    sliced = stage(
        ends.unionByName(points).repartitionByRange("at").withColumn("slice", F.spark_partition_id())
    )
    inside = F.expr(
        "min(pool) OVER (PARTITION BY slice ORDER BY at DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    )
    beyond = sliced.groupBy("slice").agg(F.min("pool").alias("first")).select(
        F.col("slice").alias("s"),
        F.expr(
            "min(first) OVER (ORDER BY slice DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
        ).alias("later"),
    )
    found = sliced.withColumn("inside", inside).join(beyond, F.col("slice") == F.col("s"))
    return found.where("point IS NOT NULL").select(
        "point.score", "point.weight", F.coalesce("inside", "later")["v"].alias("calibrated")
    )


def pools(calibrated: DataFrame) -> DataFrame:
    """``calibrated, low, high``: where each value of a fit begins and ends."""
    return calibrated.groupBy("calibrated").agg(F.min("score").alias("low"), F.max("score").alias("high"))
