"""Logistic regression by Newton steps: a few passes over the rows, each adding up one small matrix.

First-order steps need hundreds of passes here, because the features say much the same thing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.ml.param.shared import HasRegParam
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfsight.operators.staging import discard, importable, stage

#: The fit ends when no derivative of the mean loss is further from 0.
FLAT = 1e-9
STEPS = 100
#: The share of the promised fall of the loss that a step must reach, and what rounding may take.
_REACHED, _ROUNDING = 1e-4, 1e-13


class LogisticFit(Model, HasRegParam):
    """Coefficients of the vector ``scaled``; adds the log odds as ``margin``."""

    def __init__(self, coefficients: np.ndarray, intercept: float, penalty: float):
        super().__init__()
        self.coefficients: DenseVector = Vectors.dense(coefficients)
        self.intercept = intercept
        self._set(regParam=penalty)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        values = vector_to_array(F.col("scaled"))
        parts = (F.lit(float(c)) * F.get(values, F.lit(i)) for i, c in enumerate(self.coefficients))
        return dataset.withColumn("margin", sum(parts, F.lit(self.intercept)))


def fit(
    rows: DataFrame, features: list[Column], spread: list[float], label: Column, weight: Column, penalty: float
) -> LogisticFit:
    """The least weighted mean loss plus ``penalty`` times half the squared coefficients.

    Features are divided by their ``spread``, and are 0 where it is; the intercept has no penalty.
    ``rows`` are read once and written as blocks of numbers, which every step reads (and once
    more if it has to be halved). It adds up the loss, its first and its second derivatives per
    task, which Spark sums.
    """
    importable(rows.sparkSession)
    columns = [label, weight, *features]
    numbers = rows.select(*(c.cast("double").alias(f"c{i}") for i, c in enumerate(columns)))
    blocks = stage(numbers.mapInArrow(_packed, "block binary"))
    factors = np.array([1.0 / s if s > 0 else 0.0 for s in spread])
    own = np.array([0.0, *(penalty for _ in factors)])

    def measured(at: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        total, loss, slope, bend = _derivatives(blocks, factors, at)
        if not (total > 0 and np.isfinite(loss)):
            raise ValueError("the regression needs weighted rows without missing numbers")
        return loss / total + own @ at**2 / 2, slope / total + own * at, bend / total + np.diag(own)

    best = np.zeros(len(factors) + 1)
    loss, slope, bend = measured(best)
    for _ in range(STEPS):
        if np.abs(slope).max() <= FLAT:
            break
        step = np.linalg.lstsq(bend, -slope, rcond=None)[0]
        share, rounding = 1.0, _ROUNDING * abs(loss)
        found = measured(best + step)
        while found[0] > loss + _REACHED * share * (slope @ step) + rounding and share > 1e-9:
            share /= 2
            found = measured(best + share * step)
        if found[0] > loss + rounding:
            break  # no shorter step falls either: rounding is all that is left
        best = best + share * step
        loss, slope, bend = found
    discard(blocks)
    return LogisticFit(best[1:], float(best[0]), penalty)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A batch's columns one after the other in one value."""
    for batch in batches:
        block = b"".join(c.to_numpy(zero_copy_only=False).astype(float).tobytes() for c in batch.columns)
        yield pa.RecordBatch.from_arrays([pa.array([block], pa.binary())], ["block"])


def _derivatives(blocks: DataFrame, factors: np.ndarray, at: np.ndarray) -> tuple[float, float, np.ndarray, np.ndarray]:
    """Weight, loss and its first and second derivatives at ``at``, summed over the rows."""
    k = len(at)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(2), np.zeros(k), np.zeros((k, k))
        for block in (block for batch in batches for block in batch.column(0)):
            y, w, *found = np.frombuffer(block.as_buffer()).reshape(k + 1, -1)
            x = np.ones((k, len(y)))
            for i, values in enumerate(found):
                np.multiply(values, factors[i], out=x[i + 1])
            margin = at @ x
            small = np.exp(-np.abs(margin))
            p = np.where(margin >= 0, 1.0, small) / (1.0 + small)
            sums[0][:] += w.sum(), w @ (np.maximum(margin, 0.0) + np.log1p(small) - y * margin)
            sums[1][:] += x @ (w * (p - y))
            x *= np.sqrt(w * small) / (1.0 + small)
            sums[2][:] += x @ x.T
        flat = np.concatenate([s.ravel() for s in sums])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat)], ["at", "value"])

    parts = blocks.mapInArrow(add, "at int, value double")
    flat = np.zeros(2 + k + k * k)
    for place, value in parts.groupBy("at").agg(F.sum("value")).collect():
        flat[place] = value
    return flat[0], flat[1], flat[2 : 2 + k], flat[2 + k :].reshape(k, k)
