"""Ridge regression by conjugate gradients, for more features than normal equations can hold.

The matrix of the normal equations is never formed: a step needs only its product with a direction, which is one
aggregation over the rows, sparse ones at the cost of their entries. What the driver holds are a few vectors of one number per
feature, as the finished model does.
"""

from __future__ import annotations

import math
import uuid
import warnings
from collections.abc import Callable

import numpy as np
from pyspark import SparkContext
from pyspark.ml.common import _py2java
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import LinearRegressionModel
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F

#: Partial sums of so many groups of tasks meet before the last one, so no task adds up the vectors of all others.
LANES = 32
#: A weight that adds nothing, for rows on the other side: the summarizer wants some weight.
LEAST = 1e-300
TOLERANCE = 1e-13
STEPS = 1000


def linear_model(coefficients: np.ndarray, intercept: float) -> LinearRegressionModel:
    """A linear model of given coefficients: saved, loaded and applied like any other of its class."""
    context = SparkContext._active_spark_context
    java = context._jvm.org.apache.spark.ml.regression.LinearRegressionModel
    vector = _py2java(context, Vectors.dense(coefficients))
    return LinearRegressionModel(java(f"linear_{uuid.uuid4().hex[:12]}", vector, float(intercept)))


def weighted_sum(rows: DataFrame, features: str, weight: Column, means: np.ndarray) -> np.ndarray:
    """The sum of the feature vectors, less their means, times a weight of either sign."""
    sided = rows.select(
        features, F.greatest(weight, F.lit(LEAST)).alias("__up"), F.greatest(-weight, F.lit(LEAST)).alias("__down"),
        F.pmod(F.spark_partition_id(), F.lit(LANES)).alias("__lane"))
    total = Summarizer.metrics("sum")
    lanes = sided.groupBy("__lane").agg(F.sum(F.col("__up") - F.col("__down")).alias("__all"), *[
        total.summary(F.col(features), F.col(side))["sum"].alias(side) for side in ("__up", "__down")])
    found = lanes.agg(F.sum("__all").alias("__all"), *[
        Summarizer.sum(F.col(side)).alias(side) for side in ("__up", "__down")]).first()
    return found["__up"].toArray() - found["__down"].toArray() - found["__all"] * means


def conjugate_gradients(
    product: Callable[[np.ndarray], np.ndarray], right: np.ndarray, diagonal: np.ndarray,
    tolerance: float = TOLERANCE, steps: int = STEPS,
) -> tuple[np.ndarray, int, float]:
    """Solve ``A x = right`` for a symmetric positive ``A`` known by its products and its diagonal.

    Returns the solution, the steps taken and the residual relative to ``right`` (both scaled by the diagonal).
    """
    scale = 1.0 / np.sqrt(np.where(diagonal > 0, diagonal, 1.0))
    x = np.zeros_like(right)
    left = right * scale
    start = math.sqrt(left @ left)
    direction, size, taken = left.copy(), left @ left, 0
    while taken < steps and start and math.sqrt(size) > tolerance * start:
        moved = product(direction * scale) * scale
        curve = direction @ moved
        if curve <= 0:
            break
        x = x + size / curve * direction
        left = left - size / curve * moved
        before, size = size, left @ left
        direction = left + size / before * direction
        taken += 1
    return x * scale, taken, math.sqrt(size) / start if start else 0.0


def ridge(train: DataFrame, features: str, label: str, alpha: float, tolerance: float = TOLERANCE,
          steps: int = STEPS) -> LinearRegressionModel:
    """Least squares with an ``alpha * |w|^2`` penalty and a free intercept.

    ``train`` is passed over once a step and should be stored or persisted. A feature without spread gets no weight.
    Without rows all weights are missing, so that raises. A run that has not converged warns and returns what it has.
    """
    if train.isEmpty():
        raise ValueError("no rows with a label")
    moments = train.select(Summarizer.metrics("mean", "variance").summary(F.col(features)).alias("m"),
                           F.count(label).alias("n"), F.avg(label).alias("y")).first()
    n, mean_label = moments["n"], moments["y"]
    means, spread = moments["m"]["mean"].toArray(), moments["m"]["variance"].toArray() * max(n - 1, 0)
    right = weighted_sum(train, features, F.col(label) - F.lit(mean_label), means)

    def product(direction):
        scored = linear_model(direction, -float(means @ direction)).setFeaturesCol(features).setPredictionCol("__along").transform(train)
        return weighted_sum(scored, features, F.col("__along"), means) + alpha * direction

    right = np.where(spread > 0, right, 0.0)
    weights, taken, residual = conjugate_gradients(product, right, spread + alpha, tolerance, steps)
    if residual > 1e-6:
        warnings.warn(f"conjugate gradients stopped after {taken} steps at a residual of {residual:.1e}", stacklevel=2)
    return linear_model(weights, mean_label - float(means @ weights))
