"""GeoJSON boundaries (SRC3, SNK5, GEO1, GEO4).

Two layouts are read:

* a FeatureCollection document (one JSON value per file; a multiLine
  read is one task per file, fine for boundary sets);
* GeoJSON text sequences, one Feature per line (splittable; what
  ``write_features`` produces, one writer task per partition).

Coordinates are declared as STRING (the raw nested array text) and parsed
by geometry type: Polygon = 3 levels, MultiPolygon = 4.  Properties are a
MAP<STRING, STRING>.  A CRS member ``EPSG::<code>`` is honoured for 4326
and 3857 (see ``forkcast.operators.geo.to_wgs84``); none means 4326.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forkcast.operators.geo import to_wgs84

GEOMETRY = T.StructType([T.StructField("type", T.StringType()), T.StructField("coordinates", T.StringType())])
FEATURE = T.StructType([T.StructField("type", T.StringType()),
                        T.StructField("properties", T.MapType(T.StringType(), T.StringType())),
                        T.StructField("geometry", GEOMETRY)])
COLLECTION = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("crs", T.StructType([T.StructField("properties", T.StructType(
        [T.StructField("name", T.StringType())]))])),
    T.StructField("features", T.ArrayType(FEATURE))])


#: How deep the coordinates of each geometry type nest.
DEPTH = {"Point": 1, "MultiPoint": 2, "LineString": 2, "MultiLineString": 3, "Polygon": 3, "MultiPolygon": 4}


def _nested(coords: Column, depth: int) -> Column:
    return F.from_json(coords, "array<" * depth + "double" + ">" * depth)


def _points(geom_type: Column, coords: Column) -> Column:
    """ARRAY<ARRAY<DOUBLE>> of all vertices (NULL for a NULL geometry and
    for types without coordinates of their own, as GeometryCollection)."""
    out = None
    for kind, depth in DEPTH.items():
        points = _nested(coords, depth)
        for _ in range(depth - 2):
            points = F.flatten(points)
        points = F.array(points) if depth == 1 else points
        out = F.when(geom_type == kind, points) if out is None else out.when(geom_type == kind, points)
    return out


def reproject(df: DataFrame, srid: Column | None = None) -> DataFrame:
    """GEO1: every vertex of ``coordinates`` to WGS84 (further ordinates of a
    vertex stay), as GeoJSON text again; ``srid`` becomes 4326."""
    code = srid if srid is not None else F.col("srid")

    def moved(points: Column, depth: int) -> Column:
        if depth == 1:
            lon, lat = to_wgs84(points[0], points[1], code)
            return F.concat(F.array(lon, lat), F.slice(points, F.lit(3), F.greatest(F.size(points) - 2, F.lit(0))))
        return F.transform(points, lambda p: moved(p, depth - 1))

    out = None
    for kind, depth in DEPTH.items():
        text = F.to_json(moved(_nested(F.col("coordinates"), depth), depth))
        out = F.when(F.col("geometry_type") == kind, text) if out is None else out.when(F.col("geometry_type") == kind, text)
    same = code.isNull() | (code == 4326)
    return df.withColumns({"coordinates": F.when(same, F.col("coordinates")).otherwise(out), "srid": F.lit(4326)})


def features(df: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """Full features (real geometry, all properties, and ``extra`` columns as
    properties) as Feature JSON text, one per row: ``value``."""
    added = F.create_map(*[x for c in (extra or []) for x in (F.lit(c), F.col(c).cast("string"))]) if extra else None
    kept = F.coalesce(F.col("properties"), F.create_map().cast("map<string,string>"))
    if added is not None:
        kept = F.map_concat(F.map_filter(kept, lambda k, _: ~k.isin(extra)), added)
    geometry = F.when(F.col("geometry_type").isNull(), F.lit("null")).otherwise(
        F.concat(F.lit('{"type":"'), F.col("geometry_type"), F.lit('","coordinates":'), F.coalesce("coordinates", F.lit("null")), F.lit("}")))
    return df.select(F.concat(F.lit('{"type":"Feature","properties":'), F.to_json(kept, {"ignoreNullFields": "false"}), F.lit(',"geometry":'), geometry, F.lit("}")).alias("value"))


def _with_bounds(df: DataFrame, srid: Column) -> DataFrame:
    pts = _points(F.col("geometry_type"), F.col("coordinates"))
    xs = F.transform(pts, lambda p: p[0])
    ys = F.transform(pts, lambda p: p[1])
    lo_x, lo_y = to_wgs84(F.array_min(xs), F.array_min(ys), srid)
    hi_x, hi_y = to_wgs84(F.array_max(xs), F.array_max(ys), srid)
    return df.withColumns({"min_x": lo_x, "min_y": lo_y, "max_x": hi_x, "max_y": hi_y})


def _srid(name: Column) -> Column:
    code = F.regexp_extract(name, "(\\d+)\\s*$", 1)
    return F.when(name.isNull() | (code == ""), F.lit(None).cast("int")).otherwise(code.cast("int"))


def read_feature_collection(spark: SparkSession, path: str, name_key: str = "SSC_NAME") -> DataFrame:
    """One row per feature: name, properties, geometry_type, coordinates,
    srid, min/max x/y (WGS84)."""
    fc = spark.read.option("multiLine", True).schema(COLLECTION).json(path)
    f = fc.select(_srid(F.col("crs.properties.name")).alias("srid"), F.explode("features").alias("f"))
    df = f.select(F.col("f.properties")[name_key].alias("name"), F.col("f.properties").alias("properties"),
                  F.col("f.geometry.type").alias("geometry_type"),
                  F.col("f.geometry.coordinates").alias("coordinates"), "srid")
    return _with_bounds(df, F.col("srid"))


def read_feature_lines(spark: SparkSession, path: str, name_key: str = "SSC_NAME", srid: int | None = 4326) -> DataFrame:
    f = spark.read.schema(FEATURE).json(path)
    df = f.select(F.col("properties")[name_key].alias("name"), "properties",
                  F.col("geometry.type").alias("geometry_type"), F.col("geometry.coordinates").alias("coordinates"),
                  F.lit(srid).cast("int").alias("srid"))
    return _with_bounds(df, F.col("srid"))


def box_features(boundaries: DataFrame, name_col: str = "region_name", name_key: str = "SSC_NAME",
                 extra: list[str] | None = None) -> DataFrame:
    """Boxes (min/max x/y) as Feature JSON text, one per row: ``value``."""
    ring = F.array(*[F.array(F.col(x), F.col(y)) for x, y in
                     (("min_x", "min_y"), ("max_x", "min_y"), ("max_x", "max_y"), ("min_x", "max_y"),
                      ("min_x", "min_y"))])
    props = F.create_map(F.lit(name_key), F.col(name_col).cast("string"),
                         *[x for c in (extra or []) for x in (F.lit(c), F.col(c).cast("string"))])
    feat = F.struct(F.lit("Feature").alias("type"), props.alias("properties"),
                    F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")).alias("geometry"))
    return boundaries.select(F.to_json(feat).alias("value"))


def write_features(features: DataFrame, path: str) -> None:
    """GeoJSON text sequence: one Feature per line, written in parallel."""
    features.select("value").write.mode("overwrite").text(path)
