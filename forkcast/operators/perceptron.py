"""Spark's multilayer perceptron with its loss and gradient in numpy.

The estimator, its first weights, the loss, the optimiser and its ends are
those of ``MultilayerPerceptronClassifier`` (sigmoid units, softmax output,
L-BFGS over ten corrections with a strong Wolfe line search); only the sums
over the rows differ: rows are stacked once into held numpy blocks and every
evaluation is a pass of matrix products over them, one partial sum a task.
What comes back is Spark's own model.
"""

from __future__ import annotations

from collections import deque

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def layers_of(flat: np.ndarray, sizes: list[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(weights, offsets) of every layer, as views of Spark's flat vector."""
    out, at = [], 0
    for a, b in zip(sizes[:-1], sizes[1:]):
        out.append((flat[at:at + a * b].reshape(a, b), flat[at + a * b:at + (a + 1) * b]))
        at += (a + 1) * b
    return out


def loss_and_gradient(flat: np.ndarray, sizes: list[int], x: np.ndarray, y: np.ndarray, share: np.ndarray) -> tuple[float, np.ndarray]:
    """Cross-entropy and its gradient, summed over rows by their ``share``."""
    net = layers_of(flat, sizes)
    found = [x]
    for i, (w, b) in enumerate(net):
        z = found[-1] @ w
        z += b
        if i < len(net) - 1:
            np.negative(z, out=z)
            with np.errstate(over="ignore"):
                np.exp(z, out=z)
            z += 1.0
            np.reciprocal(z, out=z)
        found.append(z)
    z -= z.max(1, keepdims=True)
    e = np.exp(z)
    total = e.sum(1)
    rows = np.arange(len(y))
    loss = float((share * (np.log(total) - z[rows, y])).sum())
    back = e / total[:, None]
    back[rows, y] -= 1.0
    back *= share[:, None]
    gradient = np.empty_like(flat)
    for i, (w, b) in reversed(list(enumerate(layers_of(gradient, sizes)))):
        np.matmul(found[i].T, back, out=w)
        back.sum(0, out=b)
        if i:
            back = back @ net[i][0].T
            back *= found[i]
            np.subtract(1.0, found[i], out=found[i])
            back *= found[i]
    return loss, gradient


def stacked(rows: DataFrame, block: int) -> RDD:
    """(x, y, share) arrays of (features vector, label): the rows of a
    partition in order, several blocks of ``block`` in one.  A block counts as
    one, so a row's share is one by its block's size; a partition's last block
    may be short."""
    most = max(2048 // block, 1) * block

    def packed(x, y):
        return pa.RecordBatch.from_arrays([pa.array([v.tobytes()], pa.binary()) for v in (x, y)], names=["x", "y"])

    def stack(batches):
        x, y = None, np.empty(0, np.int64)
        for batch in batches:
            if batch.num_rows:
                more = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                x = more if x is None else np.concatenate([x, more])
                y = np.concatenate([y, batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)])
            cut = len(y) - len(y) % most
            for at in range(0, cut, most):
                yield packed(x[at:at + most], y[at:at + most])
            if cut:
                x, y = x[cut:], y[cut:]
        if len(y):
            yield packed(x, y)

    def arrays(row):
        y = np.frombuffer(row.y, np.int64)
        share, short = np.full(len(y), 1.0 / block), len(y) % block
        share[len(y) - short:] = 1.0 / max(short, 1)
        return np.frombuffer(row.x, float).reshape(len(y), -1), y, share

    plain = rows.select(vector_to_array("features").alias("x"), F.col("label").cast("double").alias("y"))
    return plain.mapInArrow(stack, "x binary, y binary").rdd.map(arrays)


def mean_loss(blocks: RDD, flat: np.ndarray, sizes: list[int]) -> tuple[float, np.ndarray]:
    """Mean over blocks of the loss, and its gradient; one pass."""
    def partial(stacks):
        total = np.zeros(2 + flat.size)
        for x, y, share in stacks:
            for at in range(0, len(y), 512):  # what a core's cache holds
                part = slice(at, at + 512)
                loss, gradient = loss_and_gradient(flat, sizes, x[part], y[part], share[part])
                total[0] += share[part].sum()
                total[1] += loss
                total[2:] += gradient
        yield total

    parts = blocks.mapPartitions(partial)
    total = parts.treeReduce(np.add) if blocks.getNumPartitions() > 64 else sum(parts.collect())
    return total[1] / max(total[0], 1.0), total[2:] / max(total[0], 1.0)


class _Failed(Exception):
    """A search along a direction found no step."""


def _direction(gradient: np.ndarray, history: deque) -> np.ndarray:
    """Two-loop recursion over (step, gradient change), the newest first."""
    d = gradient.copy()
    scale = 1.0
    if history:
        s, g = history[0]
        if not s @ g >= 0:
            raise _Failed
        scale = s @ g / (g @ g)
    weights = []
    for s, g in history:
        weights.append(s @ d / (s @ g))
        if np.isnan(weights[-1]):
            raise _Failed
        d -= weights[-1] * g
    d *= scale
    for (s, g), a in reversed(list(zip(history, weights))):
        d += (a - g @ d / (s @ g)) * s
    return -d


def _between(a: tuple, b: tuple) -> float:
    """Least point of the cubic through two (t, value, slope), kept off both ends."""
    (t0, f0, d0), (t1, f1, d1) = sorted((a, b))
    c = d0 + d1 - 3 * (f0 - f1) / (t0 - t1)
    root = np.sqrt(c * c - d0 * d1)
    t = t1 - (t1 - t0) * (d1 + root - c) / (d1 - d0 + 2 * root)
    return float(min(max(t, t0 + 0.1 * (t1 - t0)), t0 + 0.9 * (t1 - t0)))


def _step(phi, value: float, slope: float, t: float) -> float:
    """A step that meets the strong Wolfe conditions (1e-4, 0.9); ten trials
    to bracket it and ten within the bracket."""
    def zoom(low, high):
        for _ in range(10):
            t = _between(low, high)
            c = (t, *phi(t))
            if c[1] > value + 1e-4 * t * slope or c[1] >= low[1]:
                high = c
                continue
            if abs(c[2]) <= 0.9 * abs(slope):
                return t
            if c[2] * (high[0] - low[0]) >= 0:
                high = low
            low = c
        raise _Failed

    if slope > 0:
        raise _Failed
    low = (0.0, value, slope)
    for i in range(10):
        c = (t, *phi(t))
        if not np.isfinite(c[1]):
            t /= 2
            continue
        if c[1] > value + 1e-4 * t * slope or (c[1] >= low[1] and i):
            return zoom(low, c)
        if abs(c[2]) <= 0.9 * abs(slope):
            return t
        if c[2] >= 0:
            return zoom(c, low)
        low, t = c, t * 1.5
    raise _Failed


def minimise(function, start: np.ndarray, max_iter: int, tol: float, corrections: int = 10) -> tuple[np.ndarray, int]:
    """(weights, iterations) by L-BFGS from ``start``; ``function`` gives value
    and gradient.  Ends after ``max_iter`` iterations, when the value fell by at
    most ``tol`` of the first one over twenty, when the gradient's norm is
    within ``tol`` of the value, or when two searches in a row fail."""
    at: dict = {}

    def f(x):
        if "x" not in at or not np.array_equal(at["x"], x):
            at["x"], at["f"] = x, function(x)
        return at["f"]

    x = start
    value, gradient = f(x)
    first, last, failed, iterations = value, deque([np.inf], 20), False, 0
    history: deque = deque(maxlen=corrections)
    while iterations < max_iter:
        if len(last) > 1 and abs(value - max(last)) <= tol * first or np.linalg.norm(gradient) <= max(tol * value, 1e-8):
            break
        try:
            d = _direction(gradient, history)

            def phi(t):
                v, g = f(x + t * d)
                return v, float(g @ d)

            t = _step(phi, value, float(gradient @ d), 1.0 if iterations else 1.0 / np.linalg.norm(d))
            if t * np.linalg.norm(gradient) < 1e-10:
                raise _Failed
        except _Failed:
            if failed:
                break
            failed = True
            history.clear()
            continue
        moved = x + t * d
        new_value, new_gradient = f(moved)
        history.appendleft((moved - x, new_gradient - gradient))
        x, value, gradient, failed, iterations = moved, new_value, new_gradient, False, iterations + 1
        last.append(value)
    return x, iterations


def fit(estimator: MultilayerPerceptronClassifier, rows: DataFrame):
    """What ``estimator.fit(rows)`` gives, for (features vector, label 0.0, 1.0, ...)."""
    sizes = [int(n) for n in estimator.getLayers()]
    still = estimator.copy({estimator.maxIter: 0})  # a fit gives a model of the first weights
    one = rows.sparkSession.createDataFrame([(Vectors.dense([0.0] * sizes[0]), 0.0)], ["features", "label"])
    blocks = stacked(rows, estimator.getBlockSize()).persist(StorageLevel.MEMORY_AND_DISK)
    with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
        weights, _ = minimise(lambda w: mean_loss(blocks, w, sizes), still.fit(one).weights.toArray(), estimator.getMaxIter(), estimator.getTol())
    blocks.unpersist()
    return still.setInitialWeights(Vectors.dense(weights)).fit(one)
