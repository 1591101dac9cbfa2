"""Per-sample gradient descent over Spark (ML5), by parameter mixing.

Rows are dealt into shards by a hash of their key and lie in each shard in the
order of another, so neither membership nor order depends on how the table is
partitioned.  In a round every shard takes some epochs of per-sample steps
from the common weights; the shards' weights are averaged by their rows, and
so are the averages over their steps.  With one shard this is plain stochastic
gradient descent, step by step.

A step is affine in the weights, so a shard's epochs are, and so is a whole
round.  Its map is composed row by row in one pass over the table, a shard in
a task of its own, and every round then applies this (d + 1) x (d + 2) matrix.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Linear(NamedTuple):
    """w . (x - mean) / scale + b."""

    w: np.ndarray
    b: float
    mean: np.ndarray
    scale: np.ndarray

    def prediction(self, cols: list[str]):
        return sum(((F.col(c) - float(m)) / float(s)) * float(w) for c, m, s, w in zip(cols, self.mean, self.scale, self.w)) + F.lit(float(self.b))


def epochs_of(x: np.ndarray, y: np.ndarray, w: np.ndarray, b: float, rate: float, alpha: float, epochs: int) -> tuple[np.ndarray, float, np.ndarray, float]:
    """(w, b, mean of w, mean of b over all steps) after per-sample steps in
    row order: weights shrink by the penalty, then move against the error."""
    w, sum_w, sum_b = w.copy(), np.zeros(len(w)), 0.0
    shrink = 1 - rate * alpha
    for _ in range(epochs):
        for row, target in zip(x, y):
            off = rate * (w @ row + b - target)
            w *= shrink
            w -= off * row
            b -= off
            sum_w += w
            sum_b += b
    steps = max(epochs * len(y), 1)
    return w, b, sum_w / steps, sum_b / steps


class _Map:
    """What one epoch over a shard does to any start.

    A step is affine in (w, b), so an epoch is as well: ``ends`` @ (w, b, 1) is
    (w, b) after it and ``sums`` @ (w, b, 1) the sum of (w, b) over its steps.
    Rows are added in order, ``BLOCK`` at a time: the errors that a block's
    steps meet solve a triangular system, as every step sees the moves of the
    earlier ones."""

    BLOCK = 128

    def __init__(self, d: int, rate: float, alpha: float):
        self.rows, self.rate, self.shrink = 0, rate, 1 - rate * alpha
        self.ends, self.sums = np.eye(d + 1, d + 2), np.zeros((d + 1, d + 2))

    def add(self, x: np.ndarray, y: np.ndarray) -> None:
        for at in range(0, len(y), self.BLOCK):
            self._block(x[at:at + self.BLOCK], y[at:at + self.BLOCK])

    def _block(self, x: np.ndarray, y: np.ndarray) -> None:
        n, w, b = len(y), self.ends[:-1], self.ends[-1]
        powers = self.shrink ** np.arange(n + 1)
        geometric = np.cumsum(powers)
        age = np.arange(n)[:, None] - np.arange(n)[None, :] - 1
        system = np.tril(powers[np.maximum(age, 0)] * (x @ x.T) + 1, -1) * self.rate
        system[np.diag_indices(n)] = 1.0
        errors = powers[:n, None] * (x @ w) + b
        errors[:, -1] -= y
        off = np.linalg.solve(system, self.rate * errors)
        self.sums[:-1] += (geometric[n] - 1) * w - (x * geometric[n - 1::-1, None]).T @ off
        self.sums[-1] += n * b - np.arange(n, 0, -1) @ off
        self.ends = np.vstack([powers[n] * w - (x * powers[n - 1::-1, None]).T @ off, b - off.sum(0)])
        self.rows += n

    def after(self, epochs: int) -> np.ndarray:
        """Rows, and rows times the maps to (w, b) and to the mean of (w, b)
        after so many epochs, flat: the rows are the same in every epoch."""
        size = self.ends.shape[1]
        once = np.vstack([self.ends, np.eye(1, size, size - 1)])
        power, starts = np.eye(size), np.zeros((size, size))  # once^k, and the sum of the powers below k
        for bit in bin(epochs)[2:]:
            power, starts = power @ power, starts + starts @ power
            if bit == "1":
                power, starts = power @ once, starts + power
        mean = self.sums @ starts / max(epochs * self.rows, 1)
        return self.rows * np.concatenate([[1.0], power[:-1].ravel(), mean.ravel()])


def _maps(batches, d: int, rate: float, alpha: float):
    """The map of every shard, from rows ordered by shard."""
    held, shard = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        ids = batch.column("_shard").to_numpy(zero_copy_only=False)
        x = batch.column("_x").flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)
        y = batch.column("_y").to_numpy(zero_copy_only=False)
        edges = [0, *(np.flatnonzero(ids[1:] != ids[:-1]) + 1).tolist(), len(ids)]
        for lo, hi in zip(edges[:-1], edges[1:]):
            if held is None or ids[lo] != shard:
                if held is not None:
                    yield held
                held, shard = _Map(d, rate, alpha), ids[lo]
            held.add(x[lo:hi], y[lo:hi])
    if held is not None:
        yield held


def dealt(rows: DataFrame, cols: list[str], label: str, key: str, mean: np.ndarray, scale: np.ndarray, shards: int, seed: int) -> DataFrame:
    """(_shard, _order, _x standardised, _y), a task holding whole shards in order."""
    x = F.array(*[((F.col(f"`{c}`").cast("double") - float(m)) / float(s)) for c, m, s in zip(cols, mean, scale)])
    out = rows.select(F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(shards)).alias("_shard"), F.xxhash64(F.col(key), F.lit(seed + 1)).alias("_order"),
                      F.col(key).alias("_key"), x.alias("_x"), F.col(label).cast("double").alias("_y"))
    return out.repartition(min(shards, 4096), "_shard").sortWithinPartitions("_shard", "_order", "_key")


def _round_map(rows: DataFrame, d: int, rate: float, alpha: float, epochs: int) -> np.ndarray:
    """Rows, and the sums over shards of rows times the maps of (w, b, 1) to
    (w, b) and to the mean of (w, b) after a round, flat.  The mixing of
    shards is a mean, so these few numbers are all that any round needs."""
    size = 1 + 2 * (d + 1) * (d + 2)

    def run(batches):
        total = np.zeros(size)
        for shard in _maps(batches, d, rate, alpha):
            total += shard.after(epochs)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    def merge(batches):
        total = np.zeros(size)
        for batch in batches:
            for part in batch.column(0):
                total += np.frombuffer(part.as_buffer(), float)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    parts, tasks = rows.select("_shard", "_x", "_y").mapInArrow(run, "sums binary"), rows.rdd.getNumPartitions()
    if tasks > 16:  # a tree of two levels
        parts = parts.repartition(max(int(tasks ** 0.5), 2)).mapInArrow(merge, "sums binary")
    total = np.zeros(size)
    for row in parts.toLocalIterator():
        total += np.frombuffer(row.sums, float)
    return total


def _applied(total: np.ndarray, w: np.ndarray, b: float) -> np.ndarray:
    """Sums over shards of rows times (w, b, mean w, mean b) after a round from (w, b)."""
    start = np.concatenate([w, [b, 1.0]])
    return total[1:].reshape(2 * (len(w) + 1), len(start)) @ start


def _round(rows: DataFrame, w: np.ndarray, b: float, rate: float, alpha: float, epochs: int) -> np.ndarray:
    """Rows, and sums over shards of rows times (w, b, mean w, mean b)."""
    total = _round_map(rows, len(w), rate, alpha, epochs)
    return np.concatenate([total[:1], _applied(total, w, b)])


def fit(train: DataFrame, valid: DataFrame, cols: list[str], label: str, key: str = "id", rate: float = 1e-5, alpha: float = 1e-4, epochs: int = 20_000,
        local_epochs: int = 10, least_gain: float = 1e-7, patience: int = 20, shards: int | None = None, shard_rows: int = 200_000, seed: int = 42) -> Linear:
    """Averaged weights for rows without nulls.

    ``shards``: by default one for every ``shard_rows`` rows, eight at least;
    a task holds some rows of one and its map.  The fit ends after ``epochs``, or when ``patience``
    epochs (in whole rounds) gain less than ``least_gain`` in the squared
    error on ``valid``, which is computed from its X'X, read once.  No rows
    give zero weights.
    """
    from forkcast.operators.models import gram_statistics

    d = len(cols)
    if train.isEmpty():
        return Linear(np.zeros(d), 0.0, np.zeros(d), np.ones(d))
    g = gram_statistics(train, cols, label)
    n = g["n"]
    mean = g["sx"] / max(n, 1)
    var = np.diag(g["xx"]) / max(n, 1) - mean * mean
    scale = np.where(var > 1e-12 * np.maximum(np.diag(g["xx"]) / max(n, 1), 1e-300), np.sqrt(np.maximum(var, 0)), 1.0)
    v = gram_statistics(valid, cols, label)
    m = max(v["n"], 1)
    xx = (v["xx"] - np.outer(v["sx"], mean) - np.outer(mean, v["sx"]) + v["n"] * np.outer(mean, mean)) / np.outer(scale, scale)
    sx, xy = (v["sx"] - v["n"] * mean) / scale, (v["xy"] - mean * v["sy"]) / scale
    error = lambda w, b: (w @ xx @ w + 2 * b * (w @ sx) + v["n"] * b * b - 2 * (w @ xy) - 2 * b * v["sy"] + v["yy"]) / m
    rows = dealt(train, cols, label, key, mean, scale, shards or max(8, math.ceil(n / shard_rows)), seed)
    total = _round_map(rows, d, rate, alpha, local_epochs)
    w, b, sum_w, sum_b = np.zeros(d), 0.0, np.zeros(d), 0.0
    best, stall, rounds = np.inf, 0, math.ceil(epochs / local_epochs)
    for i in range(1, rounds + 1):
        mixed = _applied(total, w, b) / total[0]
        w, b = mixed[:d], mixed[d]
        sum_w, sum_b = sum_w + mixed[d + 1:-1], sum_b + mixed[-1]
        now = error(sum_w / i, sum_b / i)
        stall = stall + 1 if now > best - least_gain else 0
        best = min(best, now)
        if stall >= max(math.ceil(patience / local_epochs), 1):
            break
    return Linear(sum_w / i, sum_b / i, mean, scale)
