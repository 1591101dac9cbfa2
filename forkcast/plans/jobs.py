"""The reference's batch DAG as functions in one session:
clean -> features -> {model comparison, Spark ML metrics}.

Each stage is DataFrame -> DataFrame; between stages a table can be
written (parquet) to cut lineage, as the DAG's files do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forkcast.operators import clean, features, knn, models


def clean_stage(venue: DataFrame, overwrite_band: bool = False) -> DataFrame:
    """Median fill cost/cost_2 -> k-NN fill rating_number/votes -> drop rows
    without lat/lng -> mode fill type -> rating label from number (fill
    missing; ``overwrite_band`` relabels every row as the script does)."""
    df = clean.median_fill(venue, ["cost", "cost_2"])
    df = knn.knn_impute(df, require_predictors=True)
    df = clean.drop_missing(df, ["lat", "lng"])
    df = clean.mode_fill(df, "type")
    return clean.rating_band_fill(df, overwrite=overwrite_band)


def feature_stage(cleaned: DataFrame, parity: bool = False) -> DataFrame:
    return features.build_features(cleaned, parity=parity)


def spark_ml_stage(feats: DataFrame, parity: bool = False, split_how: str = "hash") -> DataFrame:
    """Metrics record ``pyspark STRUCT<regression STRUCT<mse, r2,
    train_time_s, infer_time_s>, classification STRUCT<accuracy,
    train_time_s, infer_time_s>>`` (one row)."""
    df = features.ensure_rating_binary(feats)
    reg = models.spark_regression(df, parity=parity, split_how=split_how)
    clf = models.spark_classification(df, parity=parity, split_how=split_how)
    def fields(frame, names):
        return F.struct(*[frame.select(F.col(n).cast("double")).scalar().alias(n) for n in names])
    reg_s = fields(reg, ["mse", "r2", "train_time_s", "infer_time_s"]).alias("regression")
    clf_s = fields(clf, ["accuracy", "train_time_s", "infer_time_s"]).alias("classification")
    return feats.sparkSession.range(1).select(F.struct(reg_s, clf_s).alias("pyspark"))


def predictive_stage(feats: DataFrame, out_dir: str, parity: bool = False) -> dict[str, DataFrame]:
    """The Predictive_modelling stage: a regression and a classification
    model, fitted on 80 % of the usable rows, saved under ``models/`` and
    scored on the rest; metrics under ``metrics/`` (one JSON row each).  A
    model without label or rows writes null metrics and no folder."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.regression import LinearRegression

    from forkcast.operators.evaluate import classification_metrics, regression_metrics
    from forkcast.sources import sinks

    df = features.ensure_rating_binary(feats)
    spark = feats.sparkSession
    specs = {
        "regression": ("rating_number", LinearRegression(featuresCol="features", labelCol="rating_number", regParam=0.0), regression_metrics,
                       () if parity else models.LEAKY_FOR_REGRESSION, "mse double, r2 double, n bigint"),
        "classification": ("rating_binary", LogisticRegression(featuresCol="features", labelCol="rating_binary", maxIter=500), classification_metrics,
                           ("rating_number", *(() if parity else models.LEAKY_FOR_CLASSIFICATION)),
                           "tn bigint, fp bigint, fn bigint, tp bigint, accuracy double, precision double, recall double, f1 double"),
    }
    out = {}
    for name, (label, estimator, score, leaky, schema) in specs.items():
        cols = models.feature_columns(df, {"id", label, *leaky}, vectors=True)
        data = df.select("id", *cols, label).dropna() if label in df.columns and cols else None
        if data is None or not clean.has_min_rows(data):
            metrics = spark.createDataFrame([tuple([None] * (schema.count(",") + 1))], schema)
        else:
            train, test = models.split(data, "hash_exact", "id")
            model = Pipeline(stages=[models.assembler(cols, "features", "skip"), estimator]).fit(train)
            sinks.save_model(model, f"{out_dir}/models/{name}")
            metrics = score(model.transform(test), label)
        sinks.write_metrics_json(metrics, f"{out_dir}/metrics/{name}.json")
        out[name] = spark.read.schema(metrics.schema).json(f"{out_dir}/metrics/{name}.json")
    return out


def run_dag(spark: SparkSession, venue: DataFrame, out_dir: str) -> DataFrame:
    """Whole pipeline with written stage outputs (lineage cut per stage)."""
    from forkcast.session import release, scratch_mark
    from forkcast.sources import sinks
    mark = scratch_mark()
    cleaned = clean_stage(venue)
    sinks.write_csv(cleaned, f"{out_dir}/interim/clean.csv")
    cleaned = sinks.read_venue_csv(spark, f"{out_dir}/interim/clean.csv")
    feats = feature_stage(cleaned)
    sinks.write_parquet(feats, f"{out_dir}/processed/features.parquet")
    feats = spark.read.parquet(f"{out_dir}/processed/features.parquet")
    predictive_stage(feats, out_dir)
    metrics = spark_ml_stage(feats)
    sinks.write_metrics_json(metrics, f"{out_dir}/metrics/pyspark.json")
    release(spark, mark)                      # intermediate tables are no longer read
    return spark.read.schema(metrics.schema).json(f"{out_dir}/metrics/pyspark.json")


def analysis_outputs(venue: DataFrame, boundaries: DataFrame, cuisines: list[str],
                     models_too: bool = False) -> dict[str, DataFrame]:
    """The analysis script's flow on one session, in its order: clean
    (labels re-derived from every rating number), then the exploratory
    tables on the CLEANED rows, the per-region counts, the feature table
    and (optionally) the model comparison.  Returns named DataFrames; the
    cleaned table is written once because everything reads it."""
    from forkcast.functions import scalars as S
    from forkcast.operators import explore, geo, profile
    from forkcast.session import materialize

    cleaned = materialize(clean_stage(venue, overwrite_band=True), "analysis-clean")
    out = {
        "head": profile.head_rows(cleaned),
        "null_profile": profile.null_profile(cleaned),
        "describe": profile.describe(cleaned, ["cost", "cost_2", "lat", "lng", "rating_number", "votes"]),
        "mean_by_label": explore.mean_by(cleaned, "rating_text", "rating_number"),
        "top_cuisines": explore.top_n(explore.value_counts(explore.explode_list(cleaned, "cuisine", "item"), "item"),
                                      "item", 10),
        "cuisine_counts": explore.list_value_counts(cleaned, "cuisine"),
        "top_suburbs": explore.top_n(explore.value_counts(cleaned, "subzone"), "subzone", 3),
        "cost_by_rating": profile.describe_by_group(cleaned, "rating_text", "cost"),
        "cost_histogram_by_label": explore.histogram_by_group(cleaned, "cost", "rating_text", 20,
                                                              ["Excellent", "Poor"]),
        "cost_rating_crosstab": explore.crosstab(
            cleaned.select(S.bin_left_closed("cost").alias("cost_bin"), "rating_text"),
            "cost_bin", "rating_text", ["Excellent", "Poor"]),
        "cost_histogram": explore.histogram(cleaned, "cost", 30),
        "cost_density": explore.kde_curve(cleaned, "cost", 200, hist_bins=30),
        "rating_distribution": explore.ordered_counts(cleaned, "rating_text", S.RATING_ORDER),
        "type_counts": explore.list_value_counts(cleaned, "type"),
        "corr_cost_votes": explore.correlation(cleaned, "cost", "votes"),
        "corr_cost_rating": explore.correlation(cleaned, "cost", "rating_number"),
        "region_counts": geo.cuisine_counts_many(cleaned, boundaries, cuisines),
        "region_bounds": geo.bounding_box(boundaries),
    }
    feats = materialize(feature_stage(cleaned), "analysis-features")
    out["features"] = feats
    if models_too:
        from forkcast.operators import evaluate, models
        from forkcast.operators.features import add_rating_binary
        df = add_rating_binary(feats.join(cleaned.select("id", "rating_text"), "id"))
        cols = models.feature_columns(df, {"id", "rating_number", "rating_binary", "rating_text_ord"}, vectors=True)
        data = df.select("id", *cols, "rating_binary").where("rating_binary IS NOT NULL")
        train, test = models.split(data, "stratified", "id", label="rating_binary")
        frames = [models.evaluate_classifier(k, train, test, cols, "rating_binary")
                  for k in ("logistic", "random_forest", "nystrom_svm", "relu_network")]
        out["classifier_comparison"] = evaluate.compare(frames)
        out["spark_ml_metrics"] = spark_ml_stage(feats)
        reg_cols = models.feature_columns(feats, {"id", "rating_number", *models.LEAKY_FOR_REGRESSION})
        out["regression_comparison"] = models.regression_comparison(feats, reg_cols, "rating_number")
        # the last table: each single model beside its scaled Spark ML pipeline
        ml = F.col("pyspark")
        out["library_vs_spark"] = (
            out["regression_comparison"].where("model = 'ols'").select(F.lit("regression").alias("task"), F.lit("plain").alias("fit"), "mse", "r2", F.lit(None).cast("double").alias("accuracy"))
            .unionByName(frames[0].select(F.lit("classification").alias("task"), F.lit("plain").alias("fit"), F.lit(None).cast("double").alias("mse"), F.lit(None).cast("double").alias("r2"), "accuracy"))
            .unionByName(out["spark_ml_metrics"].select(F.lit("regression").alias("task"), F.lit("pipeline").alias("fit"), ml["regression"]["mse"].alias("mse"), ml["regression"]["r2"].alias("r2"), F.lit(None).cast("double").alias("accuracy")))
            .unionByName(out["spark_ml_metrics"].select(F.lit("classification").alias("task"), F.lit("pipeline").alias("fit"), F.lit(None).cast("double").alias("mse"), F.lit(None).cast("double").alias("r2"), ml["classification"]["accuracy"].alias("accuracy"))))
    return out
