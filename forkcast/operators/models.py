"""Model fitting and scoring with Spark ML (FE12-FE15, ML4-ML14).

Training data are whole DataFrames; MLlib's estimators aggregate on the
executors (treeAggregate) and only d-sized or d x d summaries reach the
driver (the SGD Gram matrices come from per-task numpy partials summed by
``Summarizer``).  Inputs of iterative fits are persisted and released
after.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (LinearSVC, LogisticRegression, MultilayerPerceptronClassifier,
                                       RandomForestClassifier)
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler, VectorSlicer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forkcast.operators import kernel, network, perceptron
from forkcast.operators.evaluate import classification_metrics, regression_metrics, timed
from forkcast.operators.profile import NUMERIC_TYPES
from forkcast.operators.split import hash_split, stratified_split

# Columns derived from the regression target: dropped unless parity asks.
LEAKY_FOR_REGRESSION = ("rating_text_ord", "rating_binary")
LEAKY_FOR_CLASSIFICATION = ("rating_text_ord",)


def feature_columns(df: DataFrame, exclude=(), vectors: bool = False) -> list[str]:
    """Numeric columns (bool and decimal excluded, as the reference's
    numeric whitelist does) minus ``exclude``; with ``vectors`` also the
    sparse vector columns the feature stage emits for wide category sets."""
    ok = set(NUMERIC_TYPES) | ({"vector"} if vectors else set())
    return [c for c, t in df.dtypes if t in ok and c not in set(exclude)]


def assembler(cols: list[str], out: str = "features_raw", handle_invalid: str = "error") -> VectorAssembler:
    return VectorAssembler(inputCols=cols, outputCol=out, handleInvalid=handle_invalid)


def split(df: DataFrame, how: str = "hash", key: str = "id", label: str | None = None, seed: int = 42,
          test_fraction: float = 0.2):
    """(train, test).  ``hash``: stable hash of ``key`` (approximate sizes);
    ``hash_exact``: exactly ceil(fraction * n) test rows; ``stratified``:
    per-class exact sizes; ``random``: ``randomSplit`` as the reference
    (membership depends on partitioning)."""
    if how == "random":
        return tuple(df.randomSplit([1 - test_fraction, test_fraction], seed=seed))
    if how == "stratified":
        marked = stratified_split(df, label, key, test_fraction, seed)
    else:
        marked = hash_split(df, key, test_fraction, seed, exact=(how == "hash_exact"))
    return marked.where(~F.col("is_test")).drop("is_test"), marked.where(F.col("is_test")).drop("is_test")


def _score(model, test: DataFrame) -> tuple[DataFrame, float]:
    pred = model.transform(test).persist(StorageLevel.MEMORY_AND_DISK)
    _, secs = timed(pred.count)
    return pred, secs


def _usable(df: DataFrame, key: str, cols: list[str], label: str) -> DataFrame:
    """Rows that a fit can use: label and every feature present (what the
    assembler would skip), so the guard counts what is fitted."""
    return df.select(key, *cols, label).dropna(subset=[*cols, label])


def _enough(df: DataFrame, key: str, cols: list[str], label: str, min_rows: int) -> DataFrame | None:
    """The usable rows, held for split, fit and scores; None if there are too few."""
    if label not in df.columns or not cols:
        return None
    data = _usable(df, key, cols, label).persist(StorageLevel.MEMORY_AND_DISK)
    if data.limit(min_rows).count() < min_rows:
        data.unpersist()
        return None
    return data


_REGRESSION = "model string, mse double, r2 double, train_time_s double, infer_time_s double"
_CLASSIFICATION = ("model string, accuracy double, precision double, recall double, f1 double, "
                   "train_time_s double, infer_time_s double")


def _null_record(df: DataFrame, model: str, schema: str) -> DataFrame:
    return df.sparkSession.createDataFrame([(model, *[None] * schema.count(","))], schema)


def _fit_and_score(data: DataFrame, cols: list[str], label: str, key: str, split_how: str, seed: int, estimator, metrics,
                   name: str, schema: str) -> DataFrame:
    """Assembler -> StandardScaler(mean, std) -> estimator on the training
    part, scored on the other: one row of ``schema``.  ``data`` is held, and
    released here."""
    train, test = split(data, split_how, key, seed=seed)
    scale = [assembler(cols, handle_invalid="skip"), StandardScaler(inputCol="features_raw", outputCol="features", withMean=True, withStd=True)]
    model, t_fit = timed(Pipeline(stages=[*scale, estimator]).fit, train)
    pred, t_inf = _score(model, test)
    times = {"model": F.lit(name), "train_time_s": F.lit(t_fit), "infer_time_s": F.lit(t_inf)}
    names = [c.split()[0] for c in schema.split(", ")]
    out = metrics(pred, label).select(*[times[c].alias(c) if c in times else F.col(c) for c in names]).cache()
    out.count()
    pred.unpersist()
    data.unpersist()
    return out


def spark_regression(df: DataFrame, label: str = "rating_number", key: str = "id", parity: bool = False,
                     split_how: str = "hash", seed: int = 42, min_rows: int = 5) -> DataFrame:
    """Assembler -> StandardScaler(mean, std) -> OLS; metrics row with
    mse, r2, train_time_s, infer_time_s.  NULLs without the label column or
    with under ``min_rows`` usable rows, under the same schema."""
    excl = {label, key} | (set() if parity else set(LEAKY_FOR_REGRESSION))
    cols = feature_columns(df, excl, vectors=True)
    data = _enough(df, key, cols, label, min_rows)
    if data is None:
        return _null_record(df, "spark_ols", _REGRESSION)
    return _fit_and_score(data, cols, label, key, split_how, seed,
                          LinearRegression(featuresCol="features", labelCol=label, predictionCol="prediction"), regression_metrics, "spark_ols", _REGRESSION)


def spark_classification(df: DataFrame, label: str = "rating_binary", key: str = "id", parity: bool = False,
                         split_how: str = "hash", seed: int = 42, min_rows: int = 5) -> DataFrame:
    """Assembler -> StandardScaler -> logistic (L2 0.1, 100 iterations);
    metrics row with accuracy, precision, recall, f1 and timings.  NULLs
    without the label column or with under ``min_rows`` usable rows, under
    the same schema."""
    excl = {label, key, "rating_number"} | (set() if parity else set(LEAKY_FOR_CLASSIFICATION))
    cols = feature_columns(df, excl, vectors=True)
    data = _enough(df, key, cols, label, min_rows)
    if data is None:
        return _null_record(df, "spark_logistic", _CLASSIFICATION)
    return _fit_and_score(data, cols, label, key, split_how, seed,
                          LogisticRegression(featuresCol="features", labelCol=label, predictionCol="prediction", maxIter=100, regParam=0.1, elasticNetParam=0.0),
                          classification_metrics, "spark_logistic", _CLASSIFICATION)


def ols_fit(df: DataFrame, x_cols: list[str], label: str) -> tuple[PipelineModel, DataFrame]:
    """Ordinary least squares (normal-equation solver, no penalty)."""
    pipe = Pipeline(stages=[assembler(x_cols, "features"),
                            LinearRegression(featuresCol="features", labelCol=label, regParam=0.0, solver="normal",
                                             standardization=False)])
    model = pipe.fit(df)
    lr = model.stages[-1]
    spark = df.sparkSession
    rows = [(c, float(w)) for c, w in zip(x_cols, lr.coefficients.toArray())] + [("intercept", float(lr.intercept))]
    return model, spark.createDataFrame(rows, "term string, estimate double")


def gram_statistics(df: DataFrame, x_cols: list[str], label: str) -> dict:
    """n, X'X, X'y, y'y and column sums in ONE pass.

    Each task reduces its rows to one flattened partial (numpy, O(d^2)
    memory per task, Arrow batches in), and the partials are summed
    element-wise by ``Summarizer`` (a tree aggregation): no d^2 SQL
    expressions and no rows on the driver."""
    from pyspark.ml.stat import Summarizer

    d = len(x_cols)
    width = d * d + 2 * d + 3

    def partial(batches):
        acc = np.zeros(width)
        for pdf in batches:
            X = pdf[x_cols].to_numpy(dtype=float)
            y = pdf[label].to_numpy(dtype=float)
            ok = ~(np.isnan(X).any(axis=1) | np.isnan(y))
            X, y = X[ok], y[ok]
            acc[:d * d] += (X.T @ X).ravel()
            acc[d * d:d * d + d] += X.T @ y
            acc[d * d + d:d * d + 2 * d] += X.sum(axis=0)
            acc[-3:] += (len(y), y.sum(), y @ y)
        yield pd.DataFrame({"p": [acc.tolist()]})

    sel = df.select(*[F.col(c).cast("double").alias(c) for c in x_cols], F.col(label).cast("double").alias(label))
    parts = sel.mapInPandas(partial, "p array<double>")
    summed = parts.select(array_to_vector("p").alias("v")).select(Summarizer.sum(F.col("v")).alias("s")).first()
    total = summed["s"].toArray() if summed is not None and summed["s"] is not None else np.zeros(width)
    xx = total[:d * d].reshape(d, d)
    return dict(n=int(round(total[-3])), sy=float(total[-2]), yy=float(total[-1]),
                sx=total[d * d + d:d * d + 2 * d], xy=total[d * d:d * d + d], xx=xx)


def sgd_regression(train: DataFrame, valid: DataFrame, x_cols: list[str], label: str, eta0: float = 1e-5,
                   alpha: float = 1e-4, max_iter: int = 20000, tol: float = 1e-7, n_iter_no_change: int = 20):
    """Linear regression by gradient descent on standardised features with
    L2 penalty, constant step (the epoch equivalent of per-sample steps of
    ``eta0``, capped for stability), averaged weights and early stopping on
    a validation split.  Squared loss only needs (X'X, X'y, y'y) of each
    split, so every epoch runs on d x d summaries from one pass each; the
    result is the batch-gradient form of the update, not the per-sample
    order of a single-machine solver.  Returns (coef, intercept, mean, scale)."""
    g = gram_statistics(train, x_cols, label)
    gv = gram_statistics(valid, x_cols, label)
    n = max(g["n"], 1)
    mu = g["sx"] / n
    var = np.diag(g["xx"]) / n - mu * mu
    sd = np.where(var > 0, np.sqrt(np.maximum(var, 0)), 1.0)

    def standardised(st):
        m = max(st["n"], 1)
        # moments of z = (x - mu)/sd from raw moments
        xx = (st["xx"] - np.outer(st["sx"], mu) - np.outer(mu, st["sx"]) + m * np.outer(mu, mu)) / np.outer(sd, sd)
        sz = (st["sx"] - m * mu) / sd
        zy = (st["xy"] - mu * st["sy"]) / sd
        return m, xx, sz, zy, st["sy"], st["yy"]

    tr, va = standardised(g), standardised(gv)

    def mse(stats, w, b):
        m, xx, sz, zy, sy, yy = stats
        if m == 0:
            return float("nan")
        sse = w @ xx @ w + 2 * b * (w @ sz) + m * b * b - 2 * (w @ zy) - 2 * b * sy + yy
        return sse / m

    d = len(x_cols)
    w, b = np.zeros(d), 0.0
    wa, ba, best, stall = np.zeros(d), 0.0, float("inf"), 0
    m, xx, sz, zy, sy, yy = tr
    # One epoch of per-sample steps of size eta0 moves the weights by about
    # eta0 * n mean gradients; take that step on the mean gradient, capped
    # by 1 / (largest curvature) so the batch form stays stable for any n.
    hess = np.zeros((d + 1, d + 1))
    hess[:d, :d], hess[:d, d], hess[d, :d], hess[d, d] = xx / m, sz / m, sz / m, 1.0
    lam_max = float(np.linalg.eigvalsh(hess)[-1]) + alpha
    step = min(eta0 * m, 1.0 / lam_max)
    for it in range(1, max_iter + 1):
        grad_w = (xx @ w + b * sz - zy) / m + alpha * w
        grad_b = (w @ sz + m * b - sy) / m
        w, b = w - step * grad_w, b - step * grad_b
        wa += (w - wa) / it
        ba += (b - ba) / it
        score = mse(va, wa, ba)
        if score > best - tol:
            stall += 1
            if stall >= n_iter_no_change:
                break
        else:
            best, stall = score, 0
    return wa, ba, mu, sd


def pca_components_for(df: DataFrame, cols: list[str], variance: float = 0.95):
    """Standardise, fit PCA with k = d once, keep the smallest k whose
    cumulative explained variance is strictly above ``variance``.  Returns (k,
    ratios, fitted scaler+PCA pipeline)."""
    d = len(cols)
    assemble = assembler(cols, "features_raw", "skip")
    rows = assemble.transform(df).select("features_raw").persist(StorageLevel.MEMORY_AND_DISK)  # read by every fit; mostly sparse
    fitted = Pipeline(stages=[StandardScaler(inputCol="features_raw", outputCol="features_std", withMean=True, withStd=True),
                              PCA(k=d, inputCol="features_std", outputCol="pca_all")]).fit(rows)
    rows.unpersist()
    model = PipelineModel(stages=[assemble, *fitted.stages])
    ratios = [float(x) for x in model.stages[-1].explainedVariance.toArray()]
    cum, k = 0.0, d
    for i, r in enumerate(ratios):          # first count whose cumulative share is strictly above
        cum += r
        if cum > variance:
            k = i + 1
            break
    return k, ratios, model


def pca_variance(df: DataFrame, vec_col: str = "embedding") -> DataFrame:
    """Explained variance ratio per principal component of an array
    column: rows (component, ratio, cumulative)."""
    first = df.select(F.size(vec_col)).where(F.col(f"size({vec_col})") > 0).limit(1).collect()
    d = int(first[0][0]) if first else 0
    v = df.select(array_to_vector(F.col(vec_col).cast("array<double>")).alias("v"))
    sc = StandardScaler(inputCol="v", outputCol="z", withMean=True, withStd=False).fit(v)
    pca = PCA(k=d, inputCol="z", outputCol="p").fit(sc.transform(v))
    ratios = [float(x) for x in pca.explainedVariance.toArray()]
    rows, cum = [], 0.0
    for i, r in enumerate(ratios):
        cum += r
        rows.append((i, r, cum))
    return df.sparkSession.createDataFrame(rows, "component int, ratio double, cumulative double")


def pca_ols(train: DataFrame, test: DataFrame, cols: list[str], label: str, variance: float = 0.95):
    """Standardise -> PCA keeping ``variance`` -> OLS; (model, k, predictions).
    The PCA is fitted once, with all components; its first k are sliced."""
    k, _, pre = pca_components_for(train, cols, variance)
    keep = VectorSlicer(inputCol="pca_all", outputCol="features", indices=list(range(k)))
    rows = pre.stages[0].transform(train).select("features_raw", label).persist(StorageLevel.MEMORY_AND_DISK)
    pre_rows = PipelineModel(stages=pre.stages[1:]).transform(rows)
    fitted = Pipeline(stages=[keep, LinearRegression(featuresCol="features", labelCol=label, regParam=0.0)]).fit(pre_rows)
    rows.unpersist()
    model = PipelineModel(stages=[*pre.stages, *fitted.stages])
    return model, k, model.transform(test)


def regression_comparison(df: DataFrame, cols: list[str], label: str, key: str = "id", hash_col=None) -> DataFrame:
    """The three regressions side by side on one exact 80/20 split (EV8):
    (model, mse, r2, n) of OLS, averaged gradient descent and PCA + OLS."""
    data = df.select(key, *cols, label).dropna()
    marked = hash_split(data, key, 0.2, 42, exact=True, hash_col=hash_col)
    train, test = (marked.where(F.col("is_test") == t).drop("is_test").persist(StorageLevel.MEMORY_AND_DISK) for t in (False, True))
    ols, _ = ols_fit(train, cols, label)
    _, _, pca = pca_ols(train, test, cols, label)
    fit, valid = split(train, "hash", key, seed=7, test_fraction=0.1)
    w, b, mu, sd = sgd_regression(fit, valid, cols, label)
    descent = sum(((F.col(c) - float(mu[i])) / float(sd[i])) * float(w[i]) for i, c in enumerate(cols)) + F.lit(float(b))
    scored = [("ols", ols.transform(test)), ("gradient_descent", test.withColumn("prediction", descent)), ("pca_ols", pca)]
    rows = [(name, *regression_metrics(pred, label).select("mse", "r2", "n").first()) for name, pred in scored]
    train.unpersist()
    test.unpersist()
    return df.sparkSession.createDataFrame(rows, "model string, mse double, r2 double, n bigint")


def _fourier(X: np.ndarray, W: np.ndarray, b: np.ndarray) -> np.ndarray:
    """sqrt(2/D) cos(X W + b), computed within the result."""
    Z = np.empty((len(X), len(b)))
    for at in range(0, len(X), 1000):
        part = Z[at:at + 1000]
        np.matmul(X[at:at + 1000], W, out=part)
        part += b
        np.cos(part, out=part)
        part *= math.sqrt(2.0 / len(b))
    return Z


def random_fourier_features(df: DataFrame, in_col: str, out_col: str, d: int, n_features: int = 256,
                            gamma: float | None = None, seed: int = 42) -> DataFrame:
    """RBF kernel approximation (Rahimi & Recht 2007): z(x) = sqrt(2/D)
    cos(W x + b), W ~ N(0, 2 gamma), b ~ U(0, 2 pi).  W is d x D (small,
    shipped with the function); the product runs in numpy (a d x D matrix
    product is too wide for generated column code), a thousand rows at a time
    in the batch that is returned, so a worker holds one batch and its result."""
    rng = np.random.default_rng(seed)
    gamma = gamma if gamma is not None else 1.0 / max(d, 1)
    W = rng.normal(0.0, math.sqrt(2 * gamma), size=(d, n_features))
    b = rng.uniform(0, 2 * math.pi, size=n_features)

    @F.arrow_udf("array<double>")
    def rff(x: pa.Array) -> pa.Array:
        Z = _fourier(x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), d), W, b)
        return pa.ListArray.from_arrays(pa.array(np.arange(0, Z.size + 1, n_features, dtype=np.int32)), pa.array(Z.reshape(-1)))

    return df.withColumn(out_col, array_to_vector(rff(vector_to_array(F.col(in_col)))))


def classifier(kind: str, n_features: int, seed: int = 42, n_train: int = 1000):
    """The four classifiers of the comparison, as Spark estimators on
    ``features`` / ``label``.  The forest keeps with every row the node it has
    reached in each tree: a level then costs one comparison a row and tree
    instead of a walk from the root, and the trees are the same."""
    if kind == "logistic":
        return LogisticRegression(featuresCol="features", labelCol="label", maxIter=500,
                                  regParam=1.0 / max(n_train, 1), standardization=False)
    if kind == "random_forest":
        return RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=400, maxDepth=12,
                                      minInstancesPerNode=2, featureSubsetStrategy="sqrt", seed=seed, cacheNodeIds=True)
    if kind == "rff_svm":
        return LinearSVC(featuresCol="rff", labelCol="label", regParam=1.0 / max(n_train, 1), maxIter=200)
    if kind == "mlp":
        return MultilayerPerceptronClassifier(featuresCol="features", labelCol="label",
                                              layers=[n_features, 64, 64, 2], maxIter=1000, seed=seed)
    raise ValueError(kind)


def _spread(rows: DataFrame, n: int, least: int = 5000) -> DataFrame:
    """Held rows for a fit of many passes: ``rows`` (held, ``n`` of them) dealt
    over all cores if they lie in fewer tasks and each core gets ``least``.  A
    written table is small in bytes, so few tasks read it, and the other cores
    would be idle in every pass."""
    tasks = min(rows.sparkSession.sparkContext.defaultParallelism, n // least)
    if rows.rdd.getNumPartitions() >= tasks:
        return rows
    dealt = rows.select("features", "label").repartition(tasks).persist(StorageLevel.MEMORY_AND_DISK)
    dealt.count()
    rows.unpersist()
    return dealt


class _Scorer:
    """A fitted model that is no Spark ML one: ``transform`` adds predictions."""

    def __init__(self, transform):
        self.transform = transform


def _kernel_machine(train: DataFrame, n: int, seed: int, most: int = 256) -> _Scorer:
    """C = 1, as the penalty 1 / n of the mean hinge loss."""
    marks = kernel.landmarks(train, most, seed=seed)
    rows = kernel.mapped(train, marks).persist(StorageLevel.MEMORY_AND_DISK)
    svm = LinearSVC(featuresCol="kernel_features", labelCol="label", regParam=1.0 / max(n, 1), maxIter=200, standardization=False).fit(rows)
    rows.unpersist()
    return _Scorer(lambda df: svm.transform(kernel.mapped(df, marks)))


def _relu_network(train: DataFrame, key: str, seed: int) -> _Scorer:
    plain = lambda df: df.select(*[c for c in (key, "label") if c in df.columns], vector_to_array("features").alias("features"))
    fitted = network.fit(plain(train), key, seed=seed)
    return _Scorer(lambda df: network.predict(plain(df), fitted))


def evaluate_classifier(kind: str, train: DataFrame, test: DataFrame, cols: list[str], label: str,
                        seed: int = 42, key: str = "id") -> DataFrame:
    """Fit one classifier and score it: metric row (model, tn, fp, fn, tp,
    accuracy, precision, recall, f1, train_time_s, infer_time_s).

    ``nystrom_svm`` is the RBF kernel machine (``kernel``), ``relu_network``
    the network with early stopping (``network``); ``rff_svm`` and ``mlp`` are
    the ready-made approximations (random features; sigmoid units, fitted by
    ``perceptron``)."""
    scaled = kind in ("rff_svm", "nystrom_svm", "mlp", "relu_network")
    stages = [assembler(cols, "features_raw" if scaled else "features", "skip")]
    if scaled:
        stages.append(StandardScaler(inputCol="features_raw", outputCol="features", withMean=True, withStd=True))
    tr = train.withColumn("label", F.col(label).cast("double")).persist(StorageLevel.MEMORY_AND_DISK)
    te = test.withColumn("label", F.col(label).cast("double"))
    prep = Pipeline(stages=stages).fit(tr)
    tr_f, te_f = prep.transform(tr), prep.transform(te)
    # input width = assembled vector size (vector columns count their entries)
    first = tr_f.select("features").first()
    d = int(first["features"].size) if first is not None else len(cols)
    if kind == "rff_svm":
        tr_f = random_fourier_features(tr_f, "features", "rff", d, seed=seed)
        te_f = random_fourier_features(te_f, "features", "rff", d, seed=seed)
    tr_f = tr_f.persist(StorageLevel.MEMORY_AND_DISK)
    n_train = tr_f.count()
    if kind in ("random_forest", "mlp"):
        tr_f = _spread(tr_f, n_train)
    if kind == "nystrom_svm":
        model, t_fit = timed(_kernel_machine, tr_f, n_train, seed)
    elif kind == "relu_network":
        model, t_fit = timed(_relu_network, tr_f, key, seed)
    elif kind == "mlp":
        model, t_fit = timed(perceptron.fit, classifier(kind, d, seed, n_train), tr_f)
    else:
        model, t_fit = timed(classifier(kind, d, seed, n_train).fit, tr_f)
    pred, t_inf = _score(model, te_f)
    m = classification_metrics(pred, "label", "prediction", model=kind)
    out = m.withColumns({"train_time_s": F.lit(t_fit), "infer_time_s": F.lit(t_inf)}).cache()
    out.count()
    pred.unpersist()
    tr_f.unpersist()
    tr.unpersist()
    return out
