"""The ReLU network and the kernel machine against plain numpy."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from forkcast.operators import kernel, network
from forkcast.operators.network import Network


def frame(spark, x, y):
    return spark.createDataFrame([(i, [float(v) for v in row], float(t)) for i, (row, t) in enumerate(zip(x, y))], "id long, features array<double>, label double")


def test_gradient_is_that_of_finite_differences():
    rng = np.random.default_rng(1)
    net = Network.initial([5, 7, 4, 1], 3)
    x, y = rng.normal(size=(40, 5)), (rng.random(40) < 0.4).astype(float)
    flat, (_, got) = net.flat, net.loss_and_gradient(x, y)
    for i in range(0, flat.size, 3):
        step = np.zeros(flat.size)
        step[i] = 1e-6
        want = (net.with_flat(flat + step).loss_and_gradient(x, y)[0] - net.with_flat(flat - step).loss_and_gradient(x, y)[0]) / 2e-6
        assert got[i] == pytest.approx(want, rel=1e-4, abs=1e-5)
    loss, slope = net.penalty(0.1)
    assert loss == pytest.approx(0.05 * sum((w ** 2).sum() for w, _ in net.layers)) and slope.size == flat.size


def test_sums_over_tasks_equal_one_place(spark):
    rng = np.random.default_rng(2)
    x, y = rng.normal(size=(500, 6)), (rng.random(500) < 0.5).astype(float)
    net = Network.initial([6, 8, 1], 4)
    df = frame(spark, x, y)
    want_loss, want = net.loss_and_gradient(x, y)
    for parts in (1, 7, 40):
        n, loss, gradient = network.summed(df.repartition(parts), net)
        assert n == 500 and loss == pytest.approx(want_loss) and np.allclose(gradient, want)
    assert network.summed(df, net, gradient=False)[1] == pytest.approx(want_loss)
    assert network.summed(df.limit(0), net)[0] == 0


def test_learns_what_no_line_separates(spark):
    rng = np.random.default_rng(5)
    x = rng.uniform(-1, 1, (1500, 2))
    y = (x[:, 0] * x[:, 1] > 0).astype(float)
    df = frame(spark, x, y)
    net = network.fit(df.where("id < 1200").repartition(3), hidden=(16, 16), batches=2, rate=3e-2, epochs=60)
    scored = network.predict(df.where("id >= 1200"), net)
    assert scored.columns == ["id", "features", "label", "probability", "prediction"]
    assert scored.agg(F.avg((F.col("label") == F.col("prediction")).cast("int"))).first()[0] > 0.93
    assert network.predict(df.limit(0), net).collect() == []
    assert network.fit(df.limit(0)).layers[0][0].shape == (1, 64)


def dual_svm(k, y, c, passes=400):
    """Exact kernel machine: coordinate steps on the dual with an offset feature."""
    k = k + 1.0
    alpha, f = np.zeros(len(y)), np.zeros(len(y))
    for _ in range(passes):
        moved = 0.0
        for i in range(len(y)):
            new = min(max(alpha[i] + (1 - y[i] * f[i]) / k[i, i], 0.0), c)
            if new != alpha[i]:
                f += (new - alpha[i]) * y[i] * k[i]
                moved, alpha[i] = max(moved, abs(new - alpha[i])), new
        if moved < 1e-4:
            break
    return alpha * y


def test_nystrom_like_the_exact_dual(spark):
    from pyspark.ml.classification import LinearSVC
    rng = np.random.default_rng(6)
    x = rng.normal(size=(2000, 3))
    y = np.where((x ** 2).sum(1) + 0.3 * rng.normal(size=2000) > 2.3, 1.0, -1.0)
    train, test = slice(0, 1000), slice(1000, 2000)
    gamma = 1 / (3 * x[train].var())
    weights = dual_svm(kernel.rbf(x[train], x[train], gamma), y[train], 1.0)
    exact = np.sign((kernel.rbf(x[test], x[train], gamma) + 1) @ weights)
    df = frame(spark, x, (y + 1) / 2).withColumn("features", array_to_vector("features"))
    fit = df.where("id < 1000")
    assert kernel.scale_gamma(fit) == pytest.approx(gamma)
    marks = kernel.landmarks(fit, 120)
    assert len(marks.points) <= 120 and marks.root.shape[0] == len(marks.points)
    svm = LinearSVC(featuresCol="kernel_features", labelCol="label", regParam=1.0 / 1000, maxIter=200, standardization=False).fit(kernel.mapped(fit, marks))
    got = svm.transform(kernel.mapped(df.where("id >= 1000"), marks)).orderBy("id").select("prediction").toPandas()["prediction"].to_numpy()
    accuracy = [float((p == (y[test] + 1) / 2).mean()) for p in (got, (exact + 1) / 2)]
    assert accuracy[0] >= accuracy[1] - 0.01 and accuracy[1] > 0.9


def test_equal_rows_share_a_landmark():
    points = np.array([[0.0, 1.0], [0.0, 1.0], [2.0, 3.0]])
    k = kernel.rbf(points, points, 0.5)
    root = kernel.inverse_root(k)
    assert root.shape == (3, 2) and np.allclose(k @ root @ root.T @ k, k)
