"""Sources and sinks: GeoJSON layouts and CRS, CSV missing tokens, fills."""

import json
import math
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from forkcast.operators import clean
from forkcast.sources import geojson, sinks


def _fc(features, crs=None):
    doc = {"type": "FeatureCollection", "features": features}
    if crs:
        doc["crs"] = {"type": "name", "properties": {"name": crs}}
    return json.dumps(doc, indent=2)


FEATURES = [
    {"type": "Feature", "properties": {"SSC_NAME": "Alpha"},
     "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [2, 0], [2, 1], [0, 1], [0, 0]]]}},
    {"type": "Feature", "properties": {"SSC_NAME": "Beta"},
     "geometry": {"type": "MultiPolygon", "coordinates": [[[[5, 5], [6, 5], [6, 6], [5, 5]]],
                                                         [[[-3, 7], [-2, 7], [-2, 9], [-3, 7]]]]}},
    {"type": "Feature", "properties": {"SSC_NAME": "Gamma"}, "geometry": None},
    {"type": "Feature", "properties": {"SSC_NAME": "Alpha"},
     "geometry": {"type": "Polygon", "coordinates": [[[10, 10], [11, 10], [11, 11], [10, 10]]]}},
]


def _write(text):
    d = tempfile.mkdtemp(prefix="forkcast-test-")
    p = os.path.join(d, "regions.geojson")
    with open(p, "w") as f:
        f.write(text)
    return p


def test_feature_collection(spark):
    df = geojson.read_feature_collection(spark, _write(_fc(FEATURES)))
    rows = sorted(df.select("name", "geometry_type", "min_x", "min_y", "max_x", "max_y").collect(),
                  key=lambda r: (r.name, r.min_x if r.min_x is not None else -1))
    assert len(rows) == 4                                   # duplicate name kept, null geometry kept
    assert tuple(rows[0])[1:] == ("Polygon", 0.0, 0.0, 2.0, 1.0)
    assert tuple(rows[2])[1:] == ("MultiPolygon", -3.0, 5.0, 6.0, 9.0)
    assert rows[3].name == "Gamma" and rows[3].min_x is None
    from forkcast.operators.geo import bounding_box
    bb = bounding_box(df).first()
    assert tuple(bb) == (-3.0, 0.0, 11.0, 11.0)


def test_web_mercator_is_reprojected(spark):
    r = 6378137.0
    feat = [{"type": "Feature", "properties": {"SSC_NAME": "M"},
             "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [r * math.radians(10), 0],
                                                              [0, r * math.log(math.tan(math.pi / 4 + math.radians(20) / 2))],
                                                              [0, 0]]]}}]
    df = geojson.read_feature_collection(spark, _write(_fc(feat, "urn:ogc:def:crs:EPSG::3857")))
    row = df.first()
    assert row.srid == 3857
    assert row.max_x == pytest.approx(10.0) and row.max_y == pytest.approx(20.0)


def test_unknown_crs_fails(spark):
    df = geojson.read_feature_collection(spark, _write(_fc(FEATURES[:1], "EPSG:2193")))
    with pytest.raises(Exception):
        df.collect()


def test_csv_missing_tokens_and_quotes(spark):
    text = ('id,subzone,cuisine,type,cost,cost_2,lat,lng,rating_number,votes,rating_text\n'
            '1,  CBD ,"[\'Cafe\', \'Thai\']",NA,NaN,10,1.5,2.5,,3,Good\n'
            '2,None,"[""it\'s""]",[\'Bar\'],20,n/a,1,2,4.1,5,null\n')
    p = _write(text).replace("regions.geojson", "venues.csv")
    with open(p, "w") as f:
        f.write(text)
    rows = sorted(sinks.read_venue_csv(spark, p).collect(), key=lambda r: r.id)
    assert rows[0].subzone == "  CBD " and rows[0].cuisine == "['Cafe', 'Thai']"
    assert rows[0].type is None and rows[0].cost is None and rows[0].rating_number is None
    assert rows[1].subzone is None and rows[1].cost_2 is None and rows[1].rating_text is None
    assert rows[1].cuisine == '["it\'s"]'


def test_mode_tie_lowest_and_all_null(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, "b"), (4, "a"), (5, None)], "id int, type string")
    got = {r.id: r.type for r in clean.mode_fill(df, "type").collect()}
    assert got[5] == "a"
    nulls = spark.createDataFrame([(1, None), (2, None)], "id int, type string")
    assert [r.type for r in clean.mode_fill(nulls, "type").collect()] == [None, None]


def test_median_fill_only_missing(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None), (3, 10.0), (4, 2.0), (5, float("nan"))], "id int, cost double")
    got = {r.id: r.cost for r in clean.median_fill(df, ["cost"]).collect()}
    assert got == {1: 1.0, 2: 2.0, 3: 10.0, 4: 2.0, 5: 2.0}


def test_geojson_lines_roundtrip(spark):
    b = spark.createDataFrame([(1, "A", 0.0, 1.0, 0.0, 1.0), (2, "B", 2.0, 3.0, -1.0, 0.0)],
                              "region_id int, region_name string, min_x double, max_x double, min_y double, max_y double")
    path = sinks.scratch_path(spark, "t-geo")
    geojson.write_features(geojson.box_features(b), path)
    back = geojson.read_feature_lines(spark, path)
    assert sorted((r.name, r.min_x, r.max_y) for r in back.collect()) == [("A", 0.0, 1.0), ("B", 2.0, 0.0)]
    assert back.where(F.col("geometry_type") != "Polygon").count() == 0


def test_csv_extra_columns_any_order(spark):
    text = ('votes,name,id,cost,subzone\n'
            '3,"Cafe, One",1,12.5,CBD\n'
            'NA,Two,2,oops,None\n')
    d = tempfile.mkdtemp(prefix="forkcast-test-")
    p = os.path.join(d, "v.csv")
    with open(p, "w") as f:
        f.write(text)
    df = sinks.read_venue_csv(spark, p)
    assert df.columns == ["votes", "name", "id", "cost", "subzone"]
    types = dict(df.dtypes)
    assert types["votes"] == "double" and types["id"] == "bigint" and types["name"] == "string"
    rows = sorted(df.collect(), key=lambda r: r.id)
    assert rows[0].name == "Cafe, One" and rows[0].cost == 12.5 and rows[0].votes == 3.0
    assert rows[1].votes is None and rows[1].cost is None and rows[1].subzone is None


def test_cuisine_counts_tricky_texts(spark):
    from forkcast.operators import geo
    venue = spark.createDataFrame([
        (1, "a", "['Straße', 'Thai']"), (2, "a", "['STRASSE']"), (3, "A ", "['it\\'s']"),
        (4, "b", '["it\'s", None]'), (5, "b", "[' Thai ']"), (6, None, "['Thai']"), (7, "c", "[bad")],
        "id long, subzone string, cuisine string")
    regions = spark.createDataFrame([(1, "A"), (2, " B"), (3, "C"), (4, "A")], "region_id int, region_name string")
    def counts(name):
        return {r.region_id: r.venue_count for r in geo.cuisine_counts(venue, regions, name).collect()}
    assert counts("strasse") == {1: 2, 2: 0, 3: 0, 4: 2}          # ß folds to ss
    assert counts("it's") == {1: 1, 2: 1, 3: 0, 4: 1}            # escaped and double-quoted forms
    assert counts("thai") == {1: 1, 2: 1, 3: 0, 4: 1}            # stripped item; NULL suburb dropped
    many = geo.cuisine_counts_many(venue, regions, ["Thai", "Strasse"]).collect()
    assert {(r.region_id, r.cuisine): r.venue_count for r in many}[(1, "Strasse")] == 2
    assert {r.global_max for r in many} == {2}


def test_shared_maximum_ignores_suburbs_without_boundary(spark):
    from forkcast.operators import geo
    venue = spark.createDataFrame([(i, "elsewhere", "['Thai']") for i in range(5)] + [(9, "a", "['Thai']")],
                                  "id long, subzone string, cuisine string")
    regions = spark.createDataFrame([(1, "A")], "region_id int, region_name string")
    rows = geo.cuisine_counts_many(venue, regions, ["Thai"]).collect()
    assert [(r.venue_count, r.global_max) for r in rows] == [(1, 1)]


def test_csv_without_key_and_with_an_extra_number(spark, tmp_path):
    from forkcast.sources import sinks
    path = tmp_path / "venues.csv"
    path.write_text('subzone,cuisine,cost,extra,note,empty\n"A","[\'x\', \'y\']",10,1.5,two,\nB,Thai,NA,-3,4,\nB,Thai,7,NA,5,NA\n')
    for split in (True, False):
        df = sinks.read_venue_csv(spark, str(path), multi_line=split)
        assert dict(df.dtypes) == {"id": "bigint", "subzone": "string", "cuisine": "string", "cost": "double", "extra": "double", "note": "string", "empty": "string"}
        rows = df.orderBy("id").collect()
        assert len({r.id for r in rows}) == 3 and [r.extra for r in rows] == [1.5, -3.0, None] and rows[1].cost is None


def test_features_keep_every_vertex_and_property(spark, tmp_path):
    import json
    import math

    from forkcast.sources import geojson
    r = 6378137.0
    square = [[0, 0], [r * math.pi / 180, 0], [0, r * math.pi / 180], [0, 0]]
    shapes = {"Point": square[1], "MultiPoint": square, "LineString": square, "Polygon": [square, square], "MultiPolygon": [[square], [square, square]]}
    doc = {"type": "FeatureCollection", "crs": {"properties": {"name": "urn:ogc:def:crs:EPSG::3857"}},
           "features": [{"type": "Feature", "properties": {"SSC_NAME": k, "code": "7", "none": None}, "geometry": {"type": k, "coordinates": c}} for k, c in shapes.items()]
           + [{"type": "Feature", "properties": {"SSC_NAME": "empty"}, "geometry": None}]}
    path = tmp_path / "regions.json"
    path.write_text(json.dumps(doc))
    read = geojson.read_feature_collection(spark, str(path))
    geojson.write_features(geojson.features(geojson.reproject(read)), str(tmp_path / "out"))
    back = {r.name: r for r in geojson.read_feature_lines(spark, str(tmp_path / "out")).collect()}
    degrees = lambda c: [degrees(x) for x in c] if isinstance(c[0], list) else [math.degrees(c[0] / r), math.degrees(2 * math.atan(math.exp(c[1] / r)) - math.pi / 2)]
    flat = lambda c: [v for x in c for v in flat(x)] if isinstance(c, list) else [c]
    for kind, coords in shapes.items():
        got = json.loads(back[kind].coordinates)
        assert all(abs(a - b) < 1e-9 for a, b in zip(flat(got), flat(degrees(coords)), strict=True)), kind
        assert back[kind].geometry_type == kind and back[kind].properties == {"SSC_NAME": kind, "code": "7", "none": None}
        assert abs(back[kind].max_x - 1) < 1e-9
    assert back["empty"].geometry_type is None and back["empty"].min_x is None
    same = geojson.features(read.withColumn("srid", read.srid * 0 + 4326)).collect()
    assert {json.loads(r.value)["properties"]["SSC_NAME"]: (json.loads(r.value)["geometry"] or {}).get("coordinates") for r in same} == {**shapes, "empty": None}
