"""Logistic regression by stochastic gradient descent over partitions.

A round has two passes of Spark over the rows. The first sums the gradient and the loss at the current weights. In the second every
partition takes its rows in a seeded order of its own, a few times over, one gradient step per row with a decreasing rate, and
returns the weights it ends with. Each step adds what the row's gradient has changed since the round began to the gradient of
*all* rows, so partitions do not drift towards their own optimum and the steps' noise goes away as the weights settle. Sums
(weights by rows) are made by Spark, coordinate by coordinate and map-side first; a row for each coordinate comes to the driver, as many as
the model has. The averaged weights start the next round; the fitted ones are those of the smallest objective.

Repeatable: order and rate depend on seed, round and partition only, and sums are exact decimals, so the order in which tasks
end changes nothing. A lost executor repeats its partition's steps with the same result. A task holds the rows of one partition.

The intercept is not penalised. Rows without a label take no part; without rows the weights are zero; with one class only the
fit gives what the penalty allows.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.common import _py2java
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_ROWS, _LOSS = -1, -2


@dataclass
class SGDLogLoss:
    """Minimises mean log-loss + ``alpha`` / 2 |w|^2.

    A round makes ``passes`` passes of steps in every partition. Ends after ``max_iter`` passes, or when the objective has not fallen by
    ``tol`` (of its value) in ``patience`` rounds. ``objectives``: the value before each round of the last fit.
    """

    alpha: float = 1e-4
    max_iter: int = 1000
    passes: int = 5
    tol: float = 1e-4
    patience: int = 3
    seed: int = 42
    featuresCol: str = "features"
    labelCol: str = "target"
    objectives: list[float] = field(default_factory=list)

    def fit(self, vectors: DataFrame) -> LogisticRegressionModel:
        f = F.unwrap_udt(self.featuresCol)
        dense = F.size(f["values"])
        rows = vectors.where(F.col(self.labelCol).isNotNull()).select(
            F.col(self.labelCol).cast("double").alias("y"), F.coalesce(f["size"], dense).alias("size"),
            f["indices"].alias("i"), f["values"].alias("v"))
        square = F.expr("aggregate(v, 0D, (s, x) -> s + x * x)")
        size, n, reach = rows.agg(F.max("size"), F.count(F.lit(1)), F.avg(square)).first()
        if not n:
            size = vectors.agg(F.max(F.coalesce(f["size"], dense))).first()[0] or 0
        # The loss curves by a quarter of a row's square at most; the intercept adds one to it.
        rate = 1.0 / ((reach or 0.0) + 1.0)
        weights = best = np.zeros(size + 1)
        lowest, stale, self.objectives = np.inf, 0, []
        for k in range(max(1, self.max_iter // self.passes) + 1 if n else 0):
            gradient, loss = _gradient(rows, size, weights)
            found = loss + self.alpha / 2 * float(weights[:-1] @ weights[:-1])
            self.objectives.append(found)
            stale = 0 if found < lowest - self.tol * abs(lowest) or not np.isfinite(lowest) else stale + 1
            if found < lowest:
                lowest, best = found, weights
            if stale >= self.patience or k == max(1, self.max_iter // self.passes):
                break
            weights = _steps(rows, size, weights, gradient, rate, self.alpha, self.passes, k, self.seed)
        return _model(vectors, best, self.featuresCol, self.labelCol)


def _summed(rows: DataFrame, task, size: int) -> tuple[np.ndarray, float, float]:
    """Sums of the tasks' vectors, of their rows and of one more number, each an exact decimal."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        y, index, value = _entries(batches)
        if len(y):
            vector, extra = task(y, index, value)
            yield pa.RecordBatch.from_arrays([pa.array(np.r_[np.arange(size + 1), _ROWS, _LOSS], pa.int32()),
                                              pa.array(np.r_[vector, len(y), extra])], names=["at", "x"])

    exact = F.sum(F.col("x").cast("decimal(38,18)")).cast("double").alias("x")
    sums = rows.select("y", "i", "v").mapInArrow(run, "at int, x double").groupBy("at").agg(exact).toArrow()
    by = dict(zip(sums.column("at").to_pylist(), sums.column("x").to_pylist()))
    return np.array([by[j] for j in range(size + 1)]), by[_ROWS], by[_LOSS]


def _gradient(rows: DataFrame, size: int, weights: np.ndarray) -> tuple[np.ndarray, float]:
    """Gradient and value of the mean loss, without the penalty."""
    shared = rows.sparkSession.sparkContext.broadcast(weights)  # a number for each coordinate

    def task(y, index, value):
        w, total, loss = shared.value, np.zeros(size + 1), 0.0
        for t, i, x in zip(y, index, value):
            z = float(w[i] @ x) + w[-1]
            p = sigmoid(z)
            total[i] += (p - t) * x
            total[-1] += p - t
            loss += float(np.logaddexp(0.0, z if t == 0 else -z))
        return total, loss

    total, n, loss = _summed(rows, task, size)
    shared.unpersist()
    return total / n, loss / n


def _steps(rows: DataFrame, size: int, weights: np.ndarray, gradient: np.ndarray, rate: float, alpha: float, passes: int,
           number: int, seed: int) -> np.ndarray:
    """The weights that the partitions end a round with, averaged by rows."""
    shared = rows.sparkSession.sparkContext.broadcast((weights, gradient))  # two numbers for each coordinate

    def task(y, index, value):
        start, full = shared.value
        rng = np.random.default_rng([seed, number, TaskContext.get().partitionId()])
        return descend(y, index, value, start, full, rate, alpha, passes, number * passes * len(y), rng) * len(y), 0.0

    total, n, _ = _summed(rows, task, size)
    shared.unpersist()
    return total / n


def sigmoid(z: float) -> float:
    return 1.0 / (1.0 + np.exp(-z)) if z >= 0 else 1.0 - 1.0 / (1.0 + np.exp(z))


def _entries(batches: Iterator[pa.RecordBatch]) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """Labels, indices and values of a partition's rows; a dense row has no indices."""
    labels, index, value = [], [], []
    for batch in batches:
        labels.append(batch.column(0).to_numpy(zero_copy_only=False))
        for i, v in zip(batch.column(1), batch.column(2)):
            x = v.values.to_numpy(zero_copy_only=False)
            index.append(np.arange(len(x)) if not i.is_valid else i.values.to_numpy(zero_copy_only=False).astype(np.int64))
            value.append(np.asarray(x, dtype=np.float64))
    return (np.concatenate(labels) if labels else np.zeros(0)), index, value


def descend(y: np.ndarray, index: list[np.ndarray], value: list[np.ndarray], start: np.ndarray, full: np.ndarray, rate: float,
            alpha: float, passes: int, steps: int, rng: np.random.Generator) -> np.ndarray:
    """Weights after ``passes`` seeded passes of single-row steps from ``start``, where all rows have the gradient ``full``."""
    w, b = start[:-1].copy(), float(start[-1])
    before = [sigmoid(float(start[i] @ x) + start[-1]) for i, x in zip(index, value)]
    for _ in range(passes):
        for r in rng.permutation(len(y)):
            i, x = index[r], value[r]
            eta = rate / (1.0 + alpha * rate * steps)
            steps += 1
            change = sigmoid(float(w[i] @ x) + b) - before[r]
            w *= 1.0 - eta * alpha
            w -= eta * full[:-1]
            w[i] -= eta * change * x
            b -= eta * (change + full[-1])
    return np.r_[w, b]


def _model(vectors: DataFrame, weights: np.ndarray, features: str, label: str) -> LogisticRegressionModel:
    """The weights as a model of Spark ML, so that they are scored, saved and explained like any other."""
    context = vectors.sparkSession.sparkContext
    java = context._jvm.org.apache.spark.ml.classification.LogisticRegressionModel(
        f"SGDLogLoss_{uuid.uuid4().hex[:12]}", _py2java(context, Vectors.dense(weights[:-1])), float(weights[-1]))
    model = LogisticRegressionModel(java)
    model._resetUid(java.uid())
    return model.setFeaturesCol(features).setPredictionCol("prediction").setProbabilityCol("probability")
