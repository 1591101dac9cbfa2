"""Source / sink round trips and boundary queries (SRC1-SRC4, SNK1-SNK5,
GEO1, GEO4, AGG14).  Files go to a fresh folder under the session's
reliable checkpoint folder (the shared location the cluster names)."""

from __future__ import annotations

from pyspark.sql import functions as F

from forkcast.operators import geo, models
from forkcast.plans import jobs
from forkcast.plans.oracle_views import strip, with_views
from forkcast.plans.registry import register
from forkcast.sources import geojson, sinks
from forkcast.sources.tables import boundaries_view, read_table, venue_view


@register("csv_roundtrip", with_views("SELECT * FROM venue"))
def q_csv_roundtrip(spark, d):
    path = sinks.scratch_path(spark, "venue-csv")
    sinks.write_csv(venue_view(spark, d), path)
    return sinks.read_venue_csv(spark, path)


@register("parquet_roundtrip", with_views("SELECT * FROM venue"))
def q_parquet_roundtrip(spark, d):
    path = sinks.scratch_path(spark, "venue-parquet")
    sinks.write_parquet(venue_view(spark, d), path, partition_by=["rating_text"])
    return spark.read.parquet(path)


@register("region_bounds", with_views(
    "SELECT min(min_x) AS minx, min(min_y) AS miny, max(max_x) AS maxx, max(max_y) AS maxy FROM boundaries"))
def q_region_bounds(spark, d):
    path = sinks.scratch_path(spark, "regions-geojson")
    geojson.write_features(geojson.box_features(boundaries_view(spark, d)), path)
    back = geojson.read_feature_lines(spark, path)
    return geo.bounding_box(back)


@register("region_boxes", with_views(
    f"SELECT region_name AS name, 'Polygon' AS geometry_type, min_x, min_y, max_x, max_y FROM boundaries"))
def q_region_boxes(spark, d):
    path = sinks.scratch_path(spark, "regions-geojson")
    geojson.write_features(geojson.box_features(boundaries_view(spark, d)), path)
    return geojson.read_feature_lines(spark, path).select("name", "geometry_type", "min_x", "min_y", "max_x", "max_y")


@register("geojson_features", with_views(f"""
, long AS (SELECT lower({strip('subzone')}) AS subzone,
                  {strip("unnest(string_split(replace(replace(cuisine, '[' || chr(39), ''), chr(39) || ']', ''), chr(39) || ', ' || chr(39)))")} AS cuisine
           FROM venue WHERE subzone IS NOT NULL),
c AS (SELECT subzone, count(*) AS n FROM long WHERE lower(cuisine) = 'widget' GROUP BY subzone)
SELECT {strip('b.region_name')} AS name, CAST(coalesce(c.n, 0) AS VARCHAR) AS venue_count,
       {strip('b.region_name')} || ': ' || CAST(coalesce(c.n, 0) AS VARCHAR) AS hover_text, 'Polygon' AS geometry_type, min_x, min_y, max_x, max_y
FROM boundaries b LEFT JOIN c ON lower({strip('b.region_name')}) = c.subzone"""))
def q_geojson_features(spark, d):
    """Boundary features with the Widget count and hover label (SNK5),
    written in full and read back."""
    counts = geo.hover_text(geo.cuisine_counts(venue_view(spark, d), boundaries_view(spark, d), "Widget"))
    first, second = (sinks.scratch_path(spark, "features") for _ in range(2))
    geojson.write_features(geojson.box_features(counts, extra=["venue_count", "hover_text"]), first)
    geojson.write_features(geojson.features(geojson.reproject(geojson.read_feature_lines(spark, first))), second)
    back = geojson.read_feature_lines(spark, second)
    return back.select("name", *[F.col("properties")[c].alias(c) for c in ("venue_count", "hover_text")], "geometry_type", "min_x", "min_y", "max_x", "max_y")


@register("hover_labels", with_views(f"""
, long AS (SELECT lower({strip('subzone')}) AS subzone,
                  {strip("unnest(string_split(replace(replace(cuisine, '[' || chr(39), ''), chr(39) || ']', ''), chr(39) || ', ' || chr(39)))")} AS cuisine
           FROM venue WHERE subzone IS NOT NULL),
c AS (SELECT subzone, count(*) AS n FROM long WHERE lower(cuisine) = 'widget' GROUP BY subzone)
SELECT b.region_id, {strip('b.region_name')} || ': ' || CAST(coalesce(c.n, 0) AS VARCHAR) AS hover_text
FROM boundaries b LEFT JOIN c ON lower({strip('b.region_name')}) = c.subzone"""))
def q_hover_labels(spark, d):
    counts = geo.cuisine_counts(venue_view(spark, d), boundaries_view(spark, d), "Widget")
    return geo.hover_text(counts).select("region_id", "hover_text")


@register("reproject_mercator", with_views("""
SELECT region_id, round(degrees(min_x * 100000 / 6378137.0), 6) AS min_x,
       round(degrees(2 * atan(exp(min_y * 100000 / 6378137.0)) - pi() / 2), 6) AS min_y FROM boundaries"""))
def q_reproject_mercator(spark, d):
    b = boundaries_view(spark, d).select("region_id", (F.col("min_x") * 100000).alias("min_x"),
                                         (F.col("min_y") * 100000).alias("min_y"),
                                         (F.col("max_x") * 100000).alias("max_x"),
                                         (F.col("max_y") * 100000).alias("max_y"))
    r = geo.reproject_boxes(b, srid=3857)
    return r.select("region_id", F.round("min_x", 6).alias("min_x"), F.round("min_y", 6).alias("min_y"))


@register("metrics_json")
def q_metrics_json(spark, d):
    from forkcast.plans.q_models import _features
    metrics = jobs.spark_ml_stage(_features(spark, d))
    path = sinks.scratch_path(spark, "metrics-json")
    sinks.write_metrics_json(metrics, path)
    return spark.read.schema(metrics.schema).json(path)


@register("model_roundtrip", "SELECT count(*) AS n, CAST(0.0 AS DOUBLE) AS max_abs_diff FROM lineitem")
def q_model_roundtrip(spark, d):
    """Both models score the same rows; the saved one must not differ."""
    li = read_table(spark, d, "lineitem")
    model, _ = models.ols_fit(li, ["l_quantity", "l_discount"], "l_extendedprice")
    path = sinks.scratch_path(spark, "ols-model")
    sinks.save_model(model, path)
    first = model.transform(li).drop("features").withColumnRenamed("prediction", "p1")
    both = sinks.load_model(path).transform(first)
    return both.agg(F.count(F.lit(1)).alias("n"), F.max(F.abs(F.col("p1") - F.col("prediction"))).alias("max_abs_diff"))
