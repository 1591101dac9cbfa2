import random

from pyspark.sql import functions as F

from forkcast.operators.ranks import with_position


def test_places_within_groups(spark):
    rng = random.Random(7)
    rows = [(rng.choice(["a", "a", "a", "b", None, "c.d"]), rng.choice([None, *range(40)]), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "`g.x` string, v int, id int").repartition(13)
    got = with_position(df, ["g.x"], [F.col("v").asc_nulls_first(), F.col("id").desc()])
    assert got.columns == ["g.x", "v", "id", "position"]
    want = {}
    for g, v, i in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, -r[2])):
        want.setdefault(g, []).append((v, i))
    seen = {}
    for r in got.collect():
        seen.setdefault(r[0], {})[r.position] = (r.v, r.id)
    assert {g: [places[i] for i in range(len(places))] for g, places in seen.items()} == want


def test_places_over_everything(spark):
    rows = [(i % 7,) for i in range(1000)]
    got = with_position(spark.createDataFrame(rows, "v int"), [], [F.col("v").desc()], "place").collect()
    assert sorted(r.place for r in got) == list(range(1000))
    assert [r.v for r in sorted(got, key=lambda r: r.place)] == sorted((v for v, in rows), reverse=True)


def test_equal_rows_are_spread_and_empty_tables_stay_empty(spark):
    same = spark.range(5000).select(F.lit("x").alias("g"), F.lit(1).alias("v"))
    got = with_position(same, ["g"], [F.col("v")])
    assert sorted(r.position for r in got.collect()) == list(range(5000))
    assert with_position(same.limit(0), ["g"], [F.col("v")]).collect() == []
    assert with_position(same.limit(0), [], [F.col("v")]).collect() == []
