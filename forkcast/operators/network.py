"""A ReLU network fitted by mini-batch back-propagation over Spark (ML12).

Rows are dealt into batches by a hash of their key and written once, a folder
a batch.  A step reads one batch: every task sums the loss and gradient of its
rows, the partial sums (the size of the model) are summed in two levels, and
Adam moves the weights on the driver.  A hashed share of the rows is kept
apart for early stopping.  Which rows make a batch follows from keys alone, so
a fit does not depend on how the table is partitioned.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forkcast.session import ensure_checkpoint_dir, materialize


class Network(NamedTuple):
    """Layers of (weights, offsets); ReLU between them, a logistic output."""

    layers: list[tuple[np.ndarray, np.ndarray]]

    @classmethod
    def initial(cls, sizes: list[int], seed: int = 42) -> Network:
        """Uniform weights within sqrt(6 / (inputs + outputs)), zero offsets."""
        rng = np.random.default_rng(seed)
        pairs = list(zip(sizes[:-1], sizes[1:]))
        bounds = [np.sqrt(6.0 / (a + b)) for a, b in pairs]
        return cls([(rng.uniform(-c, c, (a, b)), rng.uniform(-c, c, b)) for (a, b), c in zip(pairs, bounds)])

    @property
    def flat(self) -> np.ndarray:
        return np.concatenate([x.reshape(-1) for layer in self.layers for x in layer])

    def with_flat(self, flat: np.ndarray) -> Network:
        out, at = [], 0
        for w, b in self.layers:
            out.append((flat[at:at + w.size].reshape(w.shape), flat[at + w.size:at + w.size + b.size]))
            at += w.size + b.size
        return Network(out)

    def outputs(self, x: np.ndarray) -> list[np.ndarray]:
        """Of every layer, the last one before its logistic function."""
        found = [x]
        for i, (w, b) in enumerate(self.layers):
            z = found[-1] @ w + b
            found.append(np.maximum(z, 0.0) if i < len(self.layers) - 1 else z)
        return found

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.outputs(x)[-1][:, 0], -500, 500)))

    def loss_and_gradient(self, x: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray]:
        """Log loss and its gradient, summed over rows, without the penalty."""
        found = self.outputs(x)
        z = found[-1][:, 0]
        loss = float((np.logaddexp(0, z) - y * z).sum())
        back = (1 / (1 + np.exp(-np.clip(z, -500, 500))) - y)[:, None]
        parts: list[np.ndarray] = []
        for i in reversed(range(len(self.layers))):
            parts = [(found[i].T @ back).reshape(-1), back.sum(0), *parts]
            if i:
                back = (back @ self.layers[i][0].T) * (found[i] > 0)
        return loss, np.concatenate(parts)

    def penalty(self, alpha: float) -> tuple[float, np.ndarray]:
        """alpha / 2 * squared weights (offsets are free), and its gradient."""
        parts = [p for w, b in self.layers for p in ((alpha * w).reshape(-1), np.zeros(b.size))]
        return alpha / 2 * sum(float((w ** 2).sum()) for w, _ in self.layers), np.concatenate(parts)


def _batches(batches):
    for batch in batches:
        if batch.num_rows:
            x = batch.column("features").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            yield x, batch.column("label").to_numpy(zero_copy_only=False)


def summed(rows: DataFrame, network: Network, gradient: bool = True) -> tuple[float, float, np.ndarray]:
    """(rows, loss, gradient) over (features array<double>, label double), the
    last two summed; every task sends one partial sum."""
    size = network.flat.size if gradient else 0

    def partial(batches):
        total = np.zeros(2 + size)
        for x, y in _batches(batches):
            for at in range(0, len(y), 4096):
                part, target = x[at:at + 4096], y[at:at + 4096]
                if gradient:
                    loss, slope = network.loss_and_gradient(part, target)
                    total[2:] += slope
                else:
                    z = network.outputs(part)[-1][:, 0]
                    loss = float((np.logaddexp(0, z) - target * z).sum())
                total[:2] += len(target), loss
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    def merge(batches):
        total = np.zeros(2 + size)
        for batch in batches:
            for part in batch.column(0):
                total += np.frombuffer(part.as_buffer(), float)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    parts = rows.select("features", "label").mapInArrow(partial, "sums binary")
    tasks = rows.rdd.getNumPartitions()
    if tasks > 16:  # a tree of two levels
        parts = parts.repartition(max(int(tasks ** 0.5), 2)).mapInArrow(merge, "sums binary")
    total = np.zeros(2 + size)
    for row in parts.collect():  # about the square root of the tasks
        total += np.frombuffer(row.sums, float)
    return total[0], total[1], total[2:]


def fit(train: DataFrame, key: str = "id", hidden: tuple[int, ...] = (64, 64), alpha: float = 1e-4, batches: int = 4, rate: float = 1e-2, epochs: int = 1000,
        patience: int = 10, least_gain: float = 1e-4, apart: float = 0.1, seed: int = 42) -> Network:
    """A network for ``train`` (key, features array<double>, label 0.0 / 1.0).

    ``apart`` of the rows, by a hash of their key, measure the loss after
    every epoch; the fit ends after ``patience`` epochs without a gain of
    ``least_gain`` and gives the best weights.  ``alpha`` is the penalty on
    squared weights for the sum over a batch, as in a mean over rows divided by
    their number.  A batch without rows is passed over; without any rows the
    initial network is returned; if no row falls apart, the training loss is
    measured instead.
    """
    place = F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(1_000_000))
    cut = int(apart * 1_000_000)
    dealt = train.select("features", F.col("label").cast("double").alias("label"), F.when(place < cut, F.lit(-1)).otherwise(F.pmod(F.xxhash64(F.col(key), F.lit(seed + 1)), F.lit(batches))).cast("int").alias("batch"))
    first = train.select(F.size("features").alias("d")).first()
    if first is None:
        return Network.initial([1, *hidden, 1], seed)
    import uuid
    path = f"{ensure_checkpoint_dir(train.sparkSession).rstrip('/')}/forkcast-tables/network-{uuid.uuid4().hex[:12]}"
    dealt.repartition("batch", F.pmod(F.hash("features"), F.lit(max(train.rdd.getNumPartitions() // batches, 1)))).write.partitionBy("batch").parquet(path)
    rows = train.sparkSession.read.parquet(path)
    network = Network.initial([first["d"], *hidden, 1], seed)
    flat, mean, square = network.flat, 0.0, 0.0
    best, kept, stall, step = np.inf, network, 0, 0
    for _ in range(epochs):
        for b in range(batches):
            n, _, gradient = summed(rows.where(F.col("batch") == b), network)
            if not n:
                continue
            step += 1
            g = (gradient + network.penalty(alpha)[1]) / n
            mean, square = 0.9 * mean + 0.1 * g, 0.999 * square + 0.001 * g * g
            flat = flat - rate * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.999 ** step)) + 1e-8)
            network = network.with_flat(flat)
        n, loss, _ = summed(rows.where("batch = -1"), network, gradient=False)
        if not n:
            n, loss, _ = summed(rows, network, gradient=False)
        if loss / max(n, 1) < best - least_gain:
            best, kept, stall = loss / max(n, 1), network, 0
        else:
            stall += 1
            if stall >= patience:
                break
    return kept


def predict(rows: DataFrame, network: Network) -> DataFrame:
    """``rows`` (with features array<double>) with probability and prediction (0.0 / 1.0)."""
    names, place = rows.columns, rows.columns.index("features")

    def score(batches):
        for batch in batches:
            x = batch.column(place).flatten().to_numpy(zero_copy_only=False)
            p = network.probability(x.reshape(batch.num_rows, -1)) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p), pa.array((p >= 0.5).astype(float))], names=[*names, "probability", "prediction"])

    from pyspark.sql import types as T
    return rows.mapInArrow(score, T.StructType([*rows.schema.fields, T.StructField("probability", T.DoubleType()), T.StructField("prediction", T.DoubleType())]))
