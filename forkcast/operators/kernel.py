"""An RBF kernel machine by Nystrom's method (ML11).

Landmarks are the centres that k-means|| seeding finds over the whole training
table (distributed, a few passes); their number is a parameter, so what the
driver holds and the tasks are sent, landmarks x (features + landmarks), does
not grow with the rows.  With K the kernel among landmarks, a row becomes
k(row, landmarks) @ K^(-1/2); inner products of such rows are the best
approximation of the kernel by these landmarks, and a linear machine on them
is the kernel machine.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Landmarks(NamedTuple):
    points: np.ndarray
    root: np.ndarray
    gamma: float

    def features(self, x: np.ndarray) -> np.ndarray:
        return rbf(x, self.points, self.gamma) @ self.root


def rbf(a: np.ndarray, b: np.ndarray, gamma: float) -> np.ndarray:
    squares = (a ** 2).sum(1)[:, None] + (b ** 2).sum(1)[None, :] - 2 * a @ b.T
    return np.exp(-gamma * np.maximum(squares, 0.0))


def inverse_root(kernel: np.ndarray, least: float = 1e-10) -> np.ndarray:
    """K^(-1/2), directions of no weight left out (equal landmarks share one)."""
    values, vectors = np.linalg.eigh(kernel)
    live = values > least * max(values.max(), 0.0)
    return vectors[:, live] / np.sqrt(values[live])


def scale_gamma(rows: DataFrame, col: str = "features") -> float:
    """1 / (features * variance of all their values); 1 for constant features."""
    row = rows.select(Summarizer.metrics("mean", "variance", "count").summary(F.col(col)).alias("s")).first()
    if row is None or row["s"] is None or not row["s"]["count"]:
        return 1.0
    mean, n = row["s"]["mean"].toArray(), row["s"]["count"]
    within = row["s"]["variance"].toArray() * (n - 1) / n
    spread = within.mean() + mean.var()
    return float(1.0 / (len(mean) * spread)) if spread > 0 else 1.0


def landmarks(rows: DataFrame, most: int = 256, col: str = "features", gamma: float | None = None, seed: int = 42) -> Landmarks:
    """At most ``most`` landmarks of a vector column, and the map they give."""
    gamma = scale_gamma(rows, col) if gamma is None else gamma
    model = KMeans(k=most, initMode="k-means||", initSteps=2, maxIter=2, seed=seed, featuresCol=col).fit(rows)
    points = np.unique(np.array(model.clusterCenters()), axis=0)
    return Landmarks(points, inverse_root(rbf(points, points, gamma)), gamma)


def mapped(rows: DataFrame, marks: Landmarks, col: str = "features", out: str = "kernel_features") -> DataFrame:
    """``rows`` with the landmark features as a vector column; one product per Arrow batch."""
    @F.pandas_udf("array<double>")
    def features(x: pd.Series) -> pd.Series:
        return pd.Series(list(marks.features(np.vstack(x.to_numpy())))) if len(x) else pd.Series([], dtype=object)

    return rows.withColumn(out, array_to_vector(features(vector_to_array(F.col(col)))))
