from pyspark.sql import Window
from pyspark.sql import functions as F

from forkcast.operators import dictionary, features


def test_a_million_values(spark):
    df = spark.range(2_000_000).select(F.concat(F.lit("v"), F.xxhash64(F.col("id") % 1_000_000).cast("string")).alias("v"))
    known = dictionary.codes(df, F.col("v"))
    assert dictionary.size(known) == 1_000_000
    want = df.distinct().select("v", (F.dense_rank().over(Window.orderBy("v")) - 1).alias("want"))
    assert known.join(want, known["value"] == want["v"]).where("code <> want").isEmpty()
    assert known.agg(F.min("code"), F.max("code"), F.count_distinct("code")).first()[:] == (0, 999_999, 1_000_000)


def test_codes_of_rows_and_lists(spark):
    df = spark.createDataFrame([("b", ["x", "a", "x", None]), ("a", []), (None, None), ("b", ["a", "zz"]), ("ß", ["x", "a", "x", None])], "k string, l array<string>")
    known = dictionary.codes(df, F.col("k"))
    assert [(r.value, r.code) for r in known.orderBy("code").collect()] == [("a", 0), ("b", 1), ("ß", 2)]
    assert sorted((r.k or "", r.c) if r.c is not None else ("", -1) for r in dictionary.encode(df, F.col("k"), known, "c").collect()) == [("", -1), ("a", 0), ("b", 1), ("b", 1), ("ß", 2)]
    items = dictionary.codes(df.select(F.explode("l").alias("v")), F.col("v"))
    got = dictionary.encode_items(df, F.col("l"), items.where("value <> 'zz'"), "c")
    assert sorted((r.k or "", r.c) for r in got.collect()) == [("", []), ("a", []), ("b", [0]), ("b", [0, 1]), ("ß", [0, 1])]
    assert dictionary.codes(df.limit(0), F.col("k")).collect() == []


def test_sparse_forms(spark):
    df = spark.createDataFrame([(1, "['b', 'a']", "q"), (2, "['c']", None), (3, None, "p"), (4, "['a', 'a']", "q")], "id long, cuisine string, zone string")
    out, known = features.multi_hot_vector(df, "cuisine")
    assert [r.value for r in known.orderBy("code").collect()] == ["a", "b", "c"]
    assert {r.id: r.cuisine_vec.toArray().tolist() for r in out.collect()} == {1: [1, 1, 0], 2: [0, 0, 1], 3: [0, 0, 0], 4: [1, 0, 0]}
    both = features.one_hot_vector(out, "zone", "zone_vec")
    assert {r.id: r.zone_vec.toArray().tolist() for r in both.collect()} == {1: [0, 1], 2: [0, 0], 3: [1, 0], 4: [0, 1]}
    assert both.select("cuisine_vec", "zone_vec").first().cuisine_vec.__class__.__name__ == "SparseVector"
