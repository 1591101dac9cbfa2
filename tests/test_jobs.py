"""The batch DAG end to end on the smallest tables."""

from forkcast.plans import jobs
from forkcast.sources import sinks
from forkcast.sources.tables import venue_view

SF = "/root/testdata/sf0.001"


def test_clean_stage_properties(spark):
    venue = venue_view(spark, SF)
    cleaned = jobs.clean_stage(venue)
    n_loc = venue.where("lat IS NOT NULL AND lng IS NOT NULL").count()
    assert cleaned.count() == n_loc                      # only rows without a location are dropped
    for c in ("cost", "cost_2", "rating_number", "votes", "type", "rating_text"):
        assert cleaned.where(f"{c} IS NULL").count() == 0, c
    # present cells are never changed
    joined = venue.alias("v").join(cleaned.alias("c"), "id")
    assert joined.where("v.rating_number IS NOT NULL AND v.rating_number <> c.rating_number").count() == 0
    assert joined.where("v.rating_text IS NOT NULL AND v.rating_text <> c.rating_text").count() == 0


def test_run_dag_writes_every_stage(spark):
    out = sinks.scratch_path(spark, "dag")
    metrics = jobs.run_dag(spark, venue_view(spark, SF), out).first()
    reg, clf = metrics.pyspark.regression, metrics.pyspark.classification
    assert reg.mse is not None and reg.mse >= 0 and reg.train_time_s >= 0
    assert clf.accuracy is None or 0 <= clf.accuracy <= 1
    feats = spark.read.parquet(f"{out}/processed/features.parquet")
    assert "suburb_density" in feats.columns and "cuisine_diversity" in feats.columns
    assert spark.read.json(f"{out}/metrics/pyspark.json").count() == 1
    assert spark.read.json(f"{out}/metrics/regression.json").first().n > 0
    assert 0 <= spark.read.json(f"{out}/metrics/classification.json").first().accuracy <= 1
    for name in ("regression", "classification"):
        assert sinks.load_model(f"{out}/models/{name}").transform(feats.dropna()).select("prediction").count() > 0


def test_release_deletes_intermediate_tables(spark):
    import os

    from forkcast.session import materialize, release, scratch_mark
    mark = scratch_mark()
    t = materialize(spark.range(10), "t-release")
    path = t.inputFiles()[0].split("/part-")[0].replace("file:", "")
    assert os.path.isdir(path)
    assert release(spark, mark) == 1
    assert not os.path.exists(path)


def test_analysis_outputs_in_script_order(spark):
    from forkcast.sources.tables import boundaries_view
    out = jobs.analysis_outputs(venue_view(spark, SF), boundaries_view(spark, SF), ["Widget", "Gear"])
    assert {"describe", "region_counts", "features", "cost_density", "rating_distribution"} <= set(out)
    # labels were re-derived from every (imputed) number: no missing label remains
    dist = {r.rating_text: r.n for r in out["rating_distribution"].collect()}
    assert sum(dist.values()) == out["features"].count()
    for name, df in out.items():
        df.limit(1).collect()                                 # every output plans and runs
