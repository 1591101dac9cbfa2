"""Models: closed-form checks and the leakage flag."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from forkcast.operators import evaluate, features, models


@pytest.fixture(scope="module")
def linear(spark):
    rng = np.random.default_rng(3)
    x1, x2 = rng.normal(size=2000), rng.normal(size=2000) * 3
    y = 3 * x1 - 2 * x2 + 1 + rng.normal(size=2000) * 0.01
    return spark.createDataFrame([(i, float(a), float(b), float(c)) for i, (a, b, c) in enumerate(zip(x1, x2, y))],
                                 "id long, x1 double, x2 double, y double"), (x1, x2, y)


def test_ols_matches_least_squares(linear):
    df, (x1, x2, y) = linear
    _, coef = models.ols_fit(df, ["x1", "x2"], "y")
    got = {r.term: r.estimate for r in coef.collect()}
    X = np.column_stack([x1, x2, np.ones_like(x1)])
    want = np.linalg.lstsq(X, y, rcond=None)[0]
    assert got["x1"] == pytest.approx(want[0], abs=1e-8) and got["x2"] == pytest.approx(want[1], abs=1e-8)
    assert got["intercept"] == pytest.approx(want[2], abs=1e-8)


def test_sgd_converges_to_the_linear_model(linear):
    df, _ = linear
    train, valid = models.split(df, "hash", "id", test_fraction=0.1)
    w, b, mu, sd = models.sgd_regression(train, valid, ["x1", "x2"], "y")
    raw = w / sd                                            # back to the unscaled slope
    assert raw[0] == pytest.approx(3.0, abs=0.01) and raw[1] == pytest.approx(-2.0, abs=0.01)
    assert b - float(np.dot(w, mu / sd)) == pytest.approx(1.0, abs=0.02)


def test_pca_variance_sums_to_one(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    out = models.pca_variance(df, "embedding").collect()
    assert out[-1].cumulative == pytest.approx(1.0, abs=1e-4)
    assert all(a.ratio >= b.ratio for a, b in zip(out, out[1:]))


def test_regression_metrics_r2_is_not_squared_correlation(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (3.0, 2.0)], "y double, prediction double")
    m = evaluate.regression_metrics(df, "y").first()
    assert m.mse == pytest.approx(2.0 / 3) and m.r2 == pytest.approx(0.0)


def test_leakage_flag(spark):
    rows = [(i, float(1 + i % 40 / 10.0), float(i % 7), ["Poor", "Average", "Good", "Very Good", "Excellent"][i % 5])
            for i in range(400)]
    df = spark.createDataFrame(rows, "id long, rating_number double, votes double, rating_text string")
    df = features.add_rating_ordinal(df).withColumn(
        "rating_text_ord", (F.col("rating_number") * 10).cast("int"))   # a function of the target
    safe = models.spark_regression(df).first()
    leaky = models.spark_regression(df, parity=True).first()
    assert leaky.r2 > 0.99 and safe.r2 < 0.5


def _venue_like(spark, n, label=lambda i: i % 2):
    rows = [(i, float(i % 7), float(i % 11), None if label(i) is None else int(label(i)), 1.0 + (i % 40) / 10.0)
            for i in range(n)]
    return spark.createDataFrame(rows, "id long, cost double, votes double, rating_binary int, rating_number double")


def test_fewer_than_five_rows_gives_null_metrics(spark):
    df = _venue_like(spark, 4)
    assert models.spark_classification(df).first().accuracy is None
    assert models.spark_regression(df).first().mse is None


def test_all_null_label_gives_null_metrics(spark):
    df = _venue_like(spark, 50, label=lambda i: None)
    assert models.spark_classification(df).first().accuracy is None


def test_single_class_still_scores(spark):
    df = _venue_like(spark, 200, label=lambda i: 1)
    m = models.spark_classification(df).first()
    assert m.accuracy == pytest.approx(1.0)


def test_ensure_rating_binary_cascade(spark):
    df = spark.createDataFrame([(1, 4.5), (2, 2.0), (3, None), (4, 3.0)], "id long, rating_number double")
    got = {r.id: r.rating_binary for r in features.ensure_rating_binary(df).collect()}
    assert got == {1: 1, 2: 0, 3: None, 4: 1}          # >= approximate median (3.0); NULL stays NULL
    ordf = spark.createDataFrame([(1, 3), (2, 2), (3, None)], "id long, rating_text_ord int")
    got = {r.id: r.rating_binary for r in features.ensure_rating_binary(ordf).collect()}
    assert got == {1: 1, 2: 0, 3: None}
    nothing = spark.createDataFrame([(1,)], "id long")
    assert features.ensure_rating_binary(nothing).first().rating_binary is None


def test_r2_with_constant_labels(spark):
    same = spark.createDataFrame([(2.0, 2.0), (2.0, 2.0)], "y double, prediction double")
    off = spark.createDataFrame([(2.0, 1.0), (2.0, 3.0)], "y double, prediction double")
    assert evaluate.regression_metrics(same, "y").first().r2 == 1.0
    assert evaluate.regression_metrics(off, "y").first().r2 == 0.0


def test_guard_counts_usable_rows_and_keeps_one_schema(spark):
    few = spark.createDataFrame([(i, float(i), None, i % 2) for i in range(30)], "id long, rating_number double, cost double, rating_binary int")
    full = spark.createDataFrame([(i, float(i % 7), float(i), i % 2) for i in range(60)], "id long, rating_number double, cost double, rating_binary int")
    for fit, score in ((models.spark_regression, "mse"), (models.spark_classification, "accuracy")):
        assert fit(few).first()[score] is None
        assert fit(few).schema.simpleString() == fit(full).schema.simpleString() and fit(full).first()[score] is not None
        assert fit(full.drop("rating_number", "rating_binary")).first()[score] is None


def test_three_regressions_on_the_feature_table(spark):
    from forkcast.plans.catalog import ORACLE, QUERIES
    d = "/root/testdata/sf0.001"
    name = "regression_comparison_features"
    rows = {r.model: r for r in QUERIES[name](spark, d).collect()}
    assert set(rows) == {"ols", "gradient_descent", "pca_ols"} and name not in ORACLE
    for model, single in (("gradient_descent", "sgd_fit"), ("pca_ols", "pca_ols")):
        one = QUERIES[single](spark, d).first()
        assert rows[model].n == one.n and rows[model].mse == pytest.approx(one.mse, rel=1e-6) and rows[model].r2 == pytest.approx(one.r2, rel=1e-6)
    assert rows["ols"].n == rows["pca_ols"].n and 0 < rows["ols"].mse < float("inf")


def test_fourier_features_within_the_result(spark):
    import tracemalloc

    from pyspark.ml.functions import array_to_vector, vector_to_array
    rng = np.random.default_rng(5)
    x, w, b = rng.normal(size=(4000, 7)), rng.normal(size=(7, 128)), rng.uniform(size=128)
    tracemalloc.start()
    got = models._fourier(x, w, b)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1.2 * got.nbytes and np.allclose(got, np.sqrt(2 / 128) * np.cos(x @ w + b))
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x[:1500])], "id long, a array<double>").select("id", array_to_vector("a").alias("v"))
    rows = models.random_fourier_features(df, "v", "z", 7, 16, gamma=0.1).select("id", vector_to_array("z").alias("z")).collect()
    draws = np.random.default_rng(42)
    w, b = draws.normal(0.0, np.sqrt(0.2), size=(7, 16)), draws.uniform(0, 2 * np.pi, size=16)
    assert len(rows) == 1500 and all(np.allclose(r.z, np.sqrt(2 / 16) * np.cos(x[r.id] @ w + b)) for r in rows)
    assert models.random_fourier_features(df.limit(0), "v", "z", 7, 16).count() == 0


def test_pca_ols_reads_its_rows_twice(spark):
    """Once for scaler and PCA, once for the regression."""
    seen = spark.sparkContext.accumulator(0)

    def count(x):
        seen.add(1)
        return x

    counted = F.udf(count, "double").asNondeterministic()
    rows = [(i, float(i % 17), float(i % 5) - 0.1 * (i % 3), float(i % 17) - 2.0 * (i % 5)) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, a double, b double, y double")
    train = df.withColumn("a", counted("a"))
    _, k, pred = models.pca_ols(train, df, ["a", "b"], "y")
    assert seen.value == 600 and k == 2 and pred.count() == 300
    assert evaluate.regression_metrics(pred, "y").first().r2 > 0.99


def test_forest_keeps_node_ids_and_its_trees(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(400, 5)).round(1)
    rows = [([float(v) for v in r], float(r[0] * r[1] + r[2] > 0)) for r in x]
    from pyspark.ml.functions import array_to_vector
    df = spark.createDataFrame(rows, "a array<double>, label double").select(array_to_vector("a").alias("features"), "label").repartition(3).persist()
    forest = models.classifier("random_forest", 5)
    assert forest.getCacheNodeIds() and forest.getNumTrees() == 400 and forest.getMaxDepth() == 12
    forest = forest.setNumTrees(12)
    plain = forest.copy({forest.cacheNodeIds: False})
    assert forest.fit(df).toDebugString.split("\n")[1:] == plain.fit(df).toDebugString.split("\n")[1:]


def test_rows_of_a_fit_lie_on_all_cores(spark):
    from pyspark.ml.functions import array_to_vector
    cores = spark.sparkContext.defaultParallelism
    df = spark.range(400).select(F.lit(None).cast("long").alias("id"), array_to_vector(F.array((F.col("id") % 90).cast("double"))).alias("features"),
                                 (F.col("id") % 2).cast("double").alias("label")).coalesce(1).persist()
    want = sorted((r.features[0], r.label) for r in df.collect())
    few = models._spread(df, 400)
    assert few is df and few.rdd.getNumPartitions() == 1
    dealt = models._spread(df, 400, least=20)
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert cores > 1 and len(sizes) == cores and max(sizes) - min(sizes) <= cores
    assert sorted((r.features[0], r.label) for r in dealt.collect()) == want
