"""Transverse Mercator grids: published control points, a numeric forward projection, whole geometries."""

import json
import math

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from forkcast.operators import geo
from forkcast.sources import geojson

A = 6378137.0


def forward(lon, lat, f, zone, south):
    """Grid coordinates by Krueger's forward series (written out apart from the inverse)."""
    n = f / (2 - f)
    e = math.sqrt(f * (2 - f))
    phi, lam = math.radians(lat), math.radians(lon - (6 * zone - 183))
    t = math.sinh(math.atanh(math.sin(phi)) - e * math.atanh(e * math.sin(phi)))
    xi, eta = math.atan2(t, math.cos(lam)), math.atanh(math.sin(lam) / math.sqrt(1 + t * t))
    alpha = [n / 2 - 2 * n ** 2 / 3 + 5 * n ** 3 / 16 + 41 * n ** 4 / 180, 13 * n ** 2 / 48 - 3 * n ** 3 / 5 + 557 * n ** 4 / 1440, 61 * n ** 3 / 240 - 103 * n ** 4 / 140, 49561 * n ** 4 / 161280]
    big = A / (1 + n) * (1 + n ** 2 / 4 + n ** 4 / 64)
    x = eta + sum(c * math.cos(2 * k * xi) * math.sinh(2 * k * eta) for k, c in enumerate(alpha, 1))
    y = xi + sum(c * math.sin(2 * k * xi) * math.cosh(2 * k * eta) for k, c in enumerate(alpha, 1))
    return 500_000 + 0.9996 * big * x, (10_000_000 if south else 0) + 0.9996 * big * y


def dms(d, m, s):
    return math.copysign(abs(d) + m / 60 + s / 3600, d)


def located(spark, rows):
    df = spark.createDataFrame(rows, "x double, y double, srid int")
    lon, lat = geo.to_wgs84(F.col("x"), F.col("y"), F.col("srid"))
    return [(r.lon, r.lat) for r in df.select(lon.alias("lon"), lat.alias("lat")).collect()]


def test_published_control_points(spark):
    """Flinders Peak and Buninyong, as in the technical manual of the Australian datum."""
    points = [(273741.297, 5796489.777, 28355, dms(144, 25, 29.52440), dms(-37, 57, 3.72030)), (228854.052, 5828259.038, 28355, dms(143, 55, 35.38390), dms(-37, 39, 10.15610)),
              (758173.797, 5828674.340, 28354, dms(143, 55, 35.38390), dms(-37, 39, 10.15610))]
    for (lon, lat), (*_, want_lon, want_lat) in zip(located(spark, [p[:3] for p in points]), points):
        assert abs(lat - want_lat) * 111_000 < 0.001 and abs(lon - want_lon) * 88_000 < 0.001


def test_zones_of_both_ellipsoids(spark):
    cases = [(code, f, zone, south, 6 * zone - 183 + off, lat) for code, f, zone, south in ((32631, geo.WGS84_F, 31, False), (32733, geo.WGS84_F, 33, True), (28356, geo.GRS80_F, 56, True), (7855, geo.GRS80_F, 55, True))
             for off in (-3.0, 0.0, 1.7, 3.4) for lat in ((0.0, 33.9, 79.0) if not south else (-0.5, -33.9, -79.0))]
    got = located(spark, [(*forward(lon, lat, f, zone, south), code) for code, f, zone, south, lon, lat in cases])
    for (lon, lat), case in zip(got, cases):
        assert abs(lat - case[5]) * 111_000 < 0.001 and abs(lon - case[4]) * 111_000 * math.cos(math.radians(case[5])) < 0.001, case


def test_whole_geometries(spark, tmp_path):
    ring = [[151.0, -33.8], [151.3, -33.8], [151.3, -34.0], [151.0, -33.8]]
    grid = [list(forward(x, y, geo.GRS80_F, 56, True)) for x, y in ring]
    doc = {"type": "FeatureCollection", "crs": {"type": "name", "properties": {"name": "urn:ogc:def:crs:EPSG::28356"}},
           "features": [{"type": "Feature", "properties": {"SSC_NAME": "A"}, "geometry": {"type": "MultiPolygon", "coordinates": [[grid], [grid]]}},
                        {"type": "Feature", "properties": {"SSC_NAME": "B"}, "geometry": None}]}
    (tmp_path / "in.geojson").write_text(json.dumps(doc))
    rows = geojson.reproject(geojson.read_feature_collection(spark, str(tmp_path / "in.geojson")))
    got = {r.geometry_type: r for r in rows.collect()}
    polygons = json.loads(got["MultiPolygon"].coordinates)
    assert len(polygons) == 2 and got["MultiPolygon"].srid == 4326
    for (lon, lat), (want_lon, want_lat) in zip(polygons[1][0], ring):
        assert abs(lon - want_lon) < 1e-8 and abs(lat - want_lat) < 1e-8


def test_unknown_codes_fail(spark):
    with pytest.raises(PySparkException, match="unsupported CRS"):
        located(spark, [(1.0, 2.0, 2154)])
