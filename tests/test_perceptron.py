"""Spark's perceptron fitted with numpy sums against Spark's own fit."""

import numpy as np
import pytest
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.functions import array_to_vector

from forkcast.operators import models, perceptron


def frame(spark, n, d, parts, classes=2):
    rng = np.random.default_rng(n)
    x = rng.normal(size=(n, d))
    y = (x[:, 0] * x[:, 1] > 0).astype(int) + (x[:, 0] > 1) * (classes - 2)
    rows = [([float(v) for v in r], float(t)) for r, t in zip(x, y)]
    return spark.createDataFrame(rows, "a array<double>, label double").repartition(parts).select(array_to_vector("a").alias("features"), "label").persist()


@pytest.mark.parametrize("n, parts, block, classes", [(700, 3, 128, 2), (50, 1, 16, 2), (5, 8, 128, 2), (900, 70, 7, 3)])
def test_weights_are_those_of_sparks_fit(spark, n, parts, block, classes):
    df = frame(spark, n, 4, parts, classes)
    est = MultilayerPerceptronClassifier(layers=[4, 6, 5, classes], maxIter=15, seed=7, blockSize=block)
    want, got = est.fit(df), perceptron.fit(est, df)
    assert np.allclose(got.weights.toArray(), want.weights.toArray(), rtol=1e-6, atol=1e-8)
    assert type(got) is type(want) and not got.transform(df).select("prediction").exceptAll(want.transform(df).select("prediction")).count()


def test_gradient_is_that_of_finite_differences():
    rng = np.random.default_rng(1)
    sizes, flat = [3, 5, 2], rng.normal(size=32)
    x, y, share = rng.normal(size=(20, 3)), rng.integers(0, 2, 20), rng.random(20)
    _, got = perceptron.loss_and_gradient(flat, sizes, x, y, share)
    for i in range(flat.size):
        step = np.zeros(flat.size)
        step[i] = 1e-6
        ends = [perceptron.loss_and_gradient(flat + s, sizes, x, y, share)[0] for s in (step, -step)]
        assert got[i] == pytest.approx((ends[0] - ends[1]) / 2e-6, rel=1e-4, abs=1e-6)


def test_minimise_ends(spark):
    bowl = lambda x: (float(((x - 3) ** 2 * [1, 50]).sum()) + 1, 2 * (x - 3) * [1, 50])
    x, n = perceptron.minimise(bowl, np.zeros(2), 200, 1e-9)
    assert np.allclose(x, 3, atol=1e-4) and 0 < n < 40
    assert perceptron.minimise(bowl, np.zeros(2), 3, 1e-9)[1] == 3
    broken = lambda x: (float("nan"), np.ones(2))
    assert perceptron.minimise(broken, np.zeros(2), 50, 1e-6)[1] == 0


def test_mlp_sums_rows_in_numpy(spark, monkeypatch):
    """The query's fit takes no pass of Spark's own perceptron."""
    passes = []
    mean_loss = perceptron.mean_loss
    monkeypatch.setattr(perceptron, "mean_loss", lambda *a: passes.append(1) or mean_loss(*a))
    small = MultilayerPerceptronClassifier(layers=[2, 3, 2], maxIter=5, seed=1)
    monkeypatch.setattr(models, "classifier", lambda *a: small)
    df = spark.createDataFrame([(i, float(i % 5), float(i % 7), i % 2) for i in range(200)], "id long, a double, b double, y int")
    m = models.evaluate_classifier("mlp", df.where("id < 160"), df.where("id >= 160"), ["a", "b"], "y").first()
    assert len(passes) >= 6 and m.tn + m.fp + m.fn + m.tp == 40
