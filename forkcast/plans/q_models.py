"""Splits, evaluation and model queries (ML1-ML14, EV1-EV8, SET1, FE11-FE15)."""

from __future__ import annotations

from pyspark.sql import functions as F

from forkcast.functions import scalars as S
from forkcast.operators import descent, evaluate, features, models
from forkcast.operators.split import hash_split, stratified_split
from forkcast.plans import jobs
from forkcast.plans.oracle_views import with_views
from forkcast.plans.q_features import FEATURE_SQL
from forkcast.plans.q_impute import CLEAN_SQL
from forkcast.plans.registry import register
from forkcast.session import materialize
from forkcast.sources.tables import read_table, venue_view

_BIN = ("CAST(CASE WHEN rating_text IN ('Poor', 'Average') THEN 0 "
        "WHEN rating_text IN ('Good', 'Very Good', 'Excellent') THEN 1 END AS INTEGER)")


def _scored(spark, d):
    """Venue rows with a fixed, deterministic scorer (no fitting): the
    metric queries check the evaluation arithmetic, not a model."""
    v = venue_view(spark, d)
    return v.select("id", "rating_number", "votes", "cost",
                    S.rating_binary("rating_text").alias("rating_binary"),
                    (F.lit(2.5) + F.col("votes") / F.lit(1000.0)).alias("prediction"),
                    (F.col("votes") > 500).cast("int").alias("pred_votes"),
                    (F.col("cost") > 200).cast("int").alias("pred_cost"))


@register("regression_metrics", with_views("""
, s AS (SELECT rating_number AS y, 2.5 + votes / 1000.0 AS p FROM venue WHERE rating_number IS NOT NULL AND votes IS NOT NULL)
SELECT round(avg(pow(y - p, 2)), 6) AS mse,
       round(CASE WHEN sum(pow(y - (SELECT avg(y) FROM s), 2)) = 0
                  THEN CASE WHEN sum(pow(y - p, 2)) = 0 THEN 1.0 ELSE 0.0 END
                  ELSE 1.0 - sum(pow(y - p, 2)) / sum(pow(y - (SELECT avg(y) FROM s), 2)) END, 6) AS r2,
       CAST(count(*) AS BIGINT) AS n FROM s"""))
def q_regression_metrics(spark, d):
    m = evaluate.regression_metrics(_scored(spark, d), "rating_number", "prediction")
    return m.select(F.round("mse", 6).alias("mse"), F.round("r2", 6).alias("r2"), "n")


def _clf_sql(pred_expr, model=None):
    name = f"'{model}' AS model, " if model else ""
    return f"""SELECT {name}CAST(count(*) FILTER (WHERE y = 0 AND p = 0) AS BIGINT) AS tn,
  CAST(count(*) FILTER (WHERE y = 0 AND p = 1) AS BIGINT) AS fp,
  CAST(count(*) FILTER (WHERE y = 1 AND p = 0) AS BIGINT) AS fn,
  CAST(count(*) FILTER (WHERE y = 1 AND p = 1) AS BIGINT) AS tp,
  round(CAST(count(*) FILTER (WHERE y = p) AS DOUBLE) / count(*), 6) AS accuracy,
  round(coalesce(CAST(count(*) FILTER (WHERE y = 1 AND p = 1) AS DOUBLE) / nullif(count(*) FILTER (WHERE p = 1), 0), 0.0), 6) AS precision,
  round(coalesce(CAST(count(*) FILTER (WHERE y = 1 AND p = 1) AS DOUBLE) / nullif(count(*) FILTER (WHERE y = 1), 0), 0.0), 6) AS recall,
  round(coalesce(2.0 * count(*) FILTER (WHERE y = 1 AND p = 1) / nullif(2 * count(*) FILTER (WHERE y = 1 AND p = 1)
        + count(*) FILTER (WHERE y = 0 AND p = 1) + count(*) FILTER (WHERE y = 1 AND p = 0), 0), 0.0), 6) AS f1
FROM (SELECT {_BIN} AS y, CAST({pred_expr} AS INTEGER) AS p FROM venue) WHERE y IS NOT NULL AND p IS NOT NULL"""


def _round_metrics(m):
    return m.withColumns({c: F.round(c, 6) for c in ("accuracy", "precision", "recall", "f1")})


@register("classification_metrics", with_views(_clf_sql("votes > 500")))
def q_classification_metrics(spark, d):
    return _round_metrics(evaluate.classification_metrics(_scored(spark, d), "rating_binary", "pred_votes"))


@register("confusion_matrix", with_views(f"""
, s AS (SELECT {_BIN} AS y, CAST(votes > 500 AS INTEGER) AS p FROM venue),
cells(truth, predicted) AS (VALUES (0, 0), (0, 1), (1, 0), (1, 1))
SELECT CAST(c.truth AS INTEGER) AS truth, CAST(c.predicted AS INTEGER) AS predicted,
       CAST(count(s.y) AS BIGINT) AS n
FROM cells c LEFT JOIN s ON s.y = c.truth AND s.p = c.predicted GROUP BY c.truth, c.predicted"""))
def q_confusion_matrix(spark, d):
    return evaluate.confusion_matrix(_scored(spark, d).where(F.col("rating_binary").isNotNull()
                                                             & F.col("pred_votes").isNotNull()),
                                     "rating_binary", "pred_votes")


@register("model_comparison", with_views(_clf_sql("votes > 500", "votes_gt_500") + "\nUNION ALL\n"
                                         + _clf_sql("cost > 200", "cost_gt_200")))
def q_model_comparison(spark, d):
    s = _scored(spark, d)
    a = evaluate.classification_metrics(s, "rating_binary", "pred_votes", model="votes_gt_500")
    b = evaluate.classification_metrics(s, "rating_binary", "pred_cost", model="cost_gt_200")
    return _round_metrics(evaluate.compare([a, b]))


@register("ols_fit", """
SELECT 'l_quantity' AS term, round(regr_slope(l_extendedprice, l_quantity), 4) AS estimate FROM lineitem
UNION ALL SELECT 'intercept', round(regr_intercept(l_extendedprice, l_quantity), 4) FROM lineitem""")
def q_ols_fit(spark, d):
    li = read_table(spark, d, "lineitem")
    _, coef = models.ols_fit(li, ["l_quantity"], "l_extendedprice")
    return coef.withColumn("estimate", F.round("estimate", 4))


def _mixed(key="id"):
    """A hash that SQL can name too: a permutation of the ids below a prime."""
    return (F.col(key) * 7919) % 1000003


_MIXED_SQL = "(id * 7919) % 1000003"


@register("split_hash", with_views(f"SELECT id, rating_text, {_MIXED_SQL} % 1000 < 200 AS is_test FROM venue"))
def q_split_hash(spark, d):
    return hash_split(venue_view(spark, d).select("id", "rating_text"), "id", 0.2, 42, hash_col=_mixed())


@register("split_hash_exact", with_views(f"""
SELECT id, rating_text, row_number() OVER (ORDER BY {_MIXED_SQL}, id) <= ceil(0.2 * count(*) OVER () - 1e-9) AS is_test
FROM venue"""))
def q_split_hash_exact(spark, d):
    """ML1 with exact sizes: ceil(0.2 n) test rows, smallest hashes."""
    return hash_split(venue_view(spark, d).select("id", "rating_text"), "id", 0.2, 42, exact=True, hash_col=_mixed())


@register("split_stratified", with_views(f"""
, v AS (SELECT id, {_BIN} AS rating_binary FROM venue)
SELECT id, rating_binary, row_number() OVER (PARTITION BY rating_binary ORDER BY {_MIXED_SQL}, id)
       <= round_even(0.2 * count(*) OVER (PARTITION BY rating_binary), 0) AS is_test
FROM v WHERE rating_binary IS NOT NULL"""))
def q_split_stratified(spark, d):
    v = venue_view(spark, d).select("id", S.rating_binary("rating_text").alias("rating_binary"))
    return stratified_split(v.where(F.col("rating_binary").isNotNull()), "rating_binary", "id", 0.2, 42, hash_col=_mixed())


@register("approx_median_label")
def q_approx_median_label(spark, d):
    v = venue_view(spark, d).select("id", "rating_number")
    return features.ensure_rating_binary(v)


def _features(spark, d):
    """Feature table, written to the reliable checkpoint folder once so the
    fits and scorers below do not recompute cleaning (as the DAG's files)."""
    cleaned = materialize(jobs.clean_stage(venue_view(spark, d)), "clean")   # read by every feature fit
    return materialize(jobs.feature_stage(cleaned), "features")


def _rounded(df):
    return df.withColumns({"rating_number": F.round("rating_number", 6), "votes": F.round("votes", 6)})


@register("clean_table", CLEAN_SQL)
def q_clean_table(spark, d):
    return _rounded(jobs.clean_stage(venue_view(spark, d)))


@register("feature_table", FEATURE_SQL)
def q_feature_table(spark, d):
    """The written feature table (the DAG's processed file)."""
    return _rounded(_features(spark, d))


@register("spark_regression")
def q_spark_regression(spark, d):
    return models.spark_regression(features.ensure_rating_binary(_features(spark, d)))


@register("spark_classification")
def q_spark_classification(spark, d):
    return models.spark_classification(features.ensure_rating_binary(_features(spark, d)))


@register("spark_ml_metrics")
def q_spark_ml_metrics(spark, d):
    return jobs.spark_ml_stage(_features(spark, d))


def _reg_data(spark, d):
    f = _features(spark, d)
    cols = models.feature_columns(f, {"id", "rating_number", *models.LEAKY_FOR_REGRESSION})
    return f, cols


@register("sgd_fit")
def q_sgd_fit(spark, d):
    f, cols = _reg_data(spark, d)
    f = f.select("id", *cols, "rating_number").dropna()
    train, test = models.split(f, "hash_exact", "id")          # exact 80/20, as train_test_split
    fit, valid = models.split(train, "hash", "id", seed=7, test_fraction=0.1)
    w, b, mu, sd = models.sgd_regression(fit, valid, cols, "rating_number")
    pred = sum(((F.col(c) - float(mu[i])) / float(sd[i])) * float(w[i]) for i, c in enumerate(cols)) + F.lit(b)
    scored = test.withColumn("prediction", pred)
    return evaluate.regression_metrics(scored, "rating_number").withColumn("model", F.lit("sgd"))


@register("sgd_per_sample")
def q_sgd_per_sample(spark, d):
    """ML5 by per-sample steps; a round is 200 epochs."""
    f, cols = _reg_data(spark, d)
    f = materialize(f.select("id", *cols, "rating_number").dropna(), "sgd")
    train, test = models.split(f, "hash_exact", "id")
    fit, valid = models.split(train, "hash", "id", seed=7, test_fraction=0.1)
    fitted = descent.fit(fit, valid, cols, "rating_number", local_epochs=200)
    scored = test.withColumn("prediction", fitted.prediction(cols))
    return evaluate.regression_metrics(scored, "rating_number").withColumn("model", F.lit("sgd_per_sample"))


@register("pca_ols")
def q_pca_ols(spark, d):
    f, cols = _reg_data(spark, d)
    f = f.select("id", *cols, "rating_number").dropna()
    train, test = models.split(f, "hash_exact", "id")          # exact 80/20, as train_test_split
    _, k, pred = models.pca_ols(train, test, cols, "rating_number")
    return evaluate.regression_metrics(pred, "rating_number").withColumn("n_components", F.lit(k))


@register("pca_variance")
def q_pca_variance(spark, d):
    p = models.pca_variance(read_table(spark, d, "embeddings"), "embedding")
    return p.withColumns({c: F.round(c, 6) for c in ("ratio", "cumulative")})


def _clf(kind):
    def run(spark, d):
        f = features.add_rating_binary(_features(spark, d).withColumn("rating_text", S.rating_band("rating_number")))
        cols = models.feature_columns(f, {"id", "rating_number", "rating_binary", "rating_text_ord"}, vectors=True)
        f = f.select("id", *cols, "rating_binary").where(F.col("rating_binary").isNotNull())
        train, test = models.split(f, "stratified", "id", label="rating_binary")
        return models.evaluate_classifier(kind, train, test, cols, "rating_binary")
    return run


for _kind, _name in (("logistic", "logreg"), ("random_forest", "random_forest"), ("rff_svm", "rff_svm"),
                     ("mlp", "mlp"), ("nystrom_svm", "nystrom_svm"), ("relu_network", "relu_network")):
    register(_name)(_clf(_kind))


@register("regression_comparison", with_views(f"""
, k AS (SELECT id, cost AS x, votes AS y FROM venue WHERE cost IS NOT NULL AND votes IS NOT NULL),
s AS (SELECT *, row_number() OVER (ORDER BY {_MIXED_SQL}, id) <= ceil(0.2 * count(*) OVER () - 1e-9) AS is_test FROM k),
f AS (SELECT regr_slope(y, x) AS a, regr_intercept(y, x) AS b FROM s WHERE NOT is_test),
m AS (SELECT avg(pow(y - a * x - b, 2)) AS mse, 1 - avg(pow(y - a * x - b, 2)) / var_pop(y) AS r2, count(*) AS n FROM s, f WHERE is_test)
SELECT model, CASE WHEN model = 'gradient_descent' THEN round(mse, -3) ELSE round(mse, 3) END AS mse,
       CASE WHEN model = 'gradient_descent' THEN round(r2, 2) ELSE round(r2, 6) END + 0.0 AS r2, CAST(n AS BIGINT) AS n
FROM m, (VALUES ('ols'), ('gradient_descent'), ('pca_ols')) AS t(model)"""))
def q_regression_comparison(spark, d):
    """EV8 on an exact split.  With one column the kept component is that
    column, so OLS and PCA + OLS equal the closed form; gradient descent, which
    stops early, comes within half a per cent of it and is rounded to that."""
    m = models.regression_comparison(venue_view(spark, d).select("id", "cost", "votes"), ["cost"], "votes", hash_col=_mixed())
    early = F.col("model") == "gradient_descent"
    return m.select("model", F.when(early, F.round("mse", -3)).otherwise(F.round("mse", 3)).alias("mse"),
                    (F.when(early, F.round("r2", 2)).otherwise(F.round("r2", 6)) + F.lit(0.0)).alias("r2"), "n")


@register("regression_comparison_features")
def q_regression_comparison_features(spark, d):
    """EV8 on the feature table: OLS, gradient descent and PCA + OLS."""
    f, cols = _reg_data(spark, d)
    return models.regression_comparison(f, cols, "rating_number")


_WIDE_METRICS = ["accuracy", "precision", "recall", "f1"]


def _wide_sql():
    clf = with_views(_clf_sql("votes > 500", "votes_gt_500") + "\nUNION ALL\n" + _clf_sql("cost > 200", "cost_gt_200"))
    body = clf[clf.index("SELECT 'votes_gt_500'"):]
    head = clf[:clf.index("SELECT 'votes_gt_500'")]
    longs = "\nUNION ALL\n".join(f"SELECT model, '{m}' AS metric, {m} AS value FROM m" for m in _WIDE_METRICS)
    return (f"{head.rstrip()}, m AS ({body}),\nl AS ({longs})\n"
            "SELECT metric, max(CASE WHEN model = 'votes_gt_500' THEN value END) AS votes_gt_500, "
            "max(CASE WHEN model = 'cost_gt_200' THEN value END) AS cost_gt_200 FROM l GROUP BY metric")


@register("model_comparison_wide", _wide_sql())
def q_model_comparison_wide(spark, d):
    s = _scored(spark, d)
    a = _round_metrics(evaluate.classification_metrics(s, "rating_binary", "pred_votes", model="votes_gt_500"))
    b = _round_metrics(evaluate.classification_metrics(s, "rating_binary", "pred_cost", model="cost_gt_200"))
    return evaluate.compare_wide([a, b], _WIDE_METRICS, names=["votes_gt_500", "cost_gt_200"])


@register("split_random")
def q_split_random(spark, d):
    """ML3 as the reference does it: ``randomSplit([0.8, 0.2], 42)``
    (membership depends on the partition layout; the catalogue's other
    splits are layout-independent)."""
    v = venue_view(spark, d).select("id", "rating_text")
    train, test = models.split(v, "random", "id", seed=42)
    return train.withColumn("is_test", F.lit(False)).unionByName(test.withColumn("is_test", F.lit(True)))


@register("feature_profile")
def q_feature_profile(spark, d):
    """PRF2-PRF5 on the finished feature table (the reference re-profiles it)."""
    from forkcast.operators import profile
    return profile.null_profile(_features(spark, d))


@register("feature_describe")
def q_feature_describe(spark, d):
    """PRF6 on every numeric feature column (quantiles batched per pass)."""
    from forkcast.operators import profile
    return profile.describe(_features(spark, d))
