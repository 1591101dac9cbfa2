"""Unit goldens for the scalar column functions (FIXTURES.md §4)."""

from pyspark.sql import functions as F

from forkcast.functions import scalars as S
from forkcast.functions import text as T


def _col(spark, values, dtype="double"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {dtype}")


def test_left_closed_bins(spark):
    vals = [0.0, 19.99, 20.0, 50.0, 100.0, 200.0, 499.99, 500.0, 501.0, -1.0, None]
    got = [r[0] for r in _col(spark, vals).orderBy("i").select(S.bin_left_closed("x")).collect()]
    assert got == ["[0, 20)", "[0, 20)", "[20, 50)", "[50, 100)", "[100, 200)", "[200, 500)", "[200, 500)",
                   None, None, None, None]


def test_right_closed_bins(spark):
    vals = [0.0, 19.99, 20.0, 50.0, 100.0, 200.0, 499.99, 500.0, 501.0, -1.0, None]
    got = [r[0] for r in _col(spark, vals).orderBy("i").select(S.bin_right_closed("x")).collect()]
    assert got == ["Low", "Low", "Low", "Low", "Medium", "High", "Luxury", "Luxury", None, None, None]


def test_rating_bands(spark):
    vals = [2.49, 2.5, 3.49, 3.5, 3.99, 4.0, 4.49, 4.5, 5.0, None]
    got = [r[0] for r in _col(spark, vals).orderBy("i").select(S.rating_band("x")).collect()]
    assert got == ["Poor", "Average", "Average", "Good", "Good", "Very Good", "Very Good", "Excellent",
                   "Excellent", None]


def test_label_maps(spark):
    df = _col(spark, ["Poor", "Average", "Good", "Very Good", "Excellent", "other", None], "string")
    got = [tuple(r) for r in df.orderBy("i").select(S.rating_ordinal("x"), S.rating_binary("x")).collect()]
    assert got == [(1, 0), (2, 0), (3, 1), (4, 1), (5, 1), (None, None), (None, None)]


def test_list_parsing(spark):
    texts = ["['a','b']", '["it\'s"]', "['it\\'s']", "[]", "x", "[bad", "['a', None]", "['a',]",
             "['a','a',' ']", None]
    df = _col(spark, texts, "string")
    rows = df.orderBy("i").select(T.parse_list("x").alias("strict"), T.list_column("x").alias("clean"),
                                  T.list_column("x", parity=True).alias("parity")).collect()
    strict = [r["strict"] for r in rows]
    assert strict[:4] == [["a", "b"], ["it's"], ["it's"], []]
    assert strict[4] is None and strict[5] is None
    assert strict[6] == ["a", None] and strict[7] == ["a"]
    clean = [r["clean"] for r in rows]
    assert clean == [["a", "b"], ["it's"], ["it's"], [], ["x"], ["[bad"], ["a", "None"], ["a"], ["a", "a"], None]
    assert rows[-1]["parity"] == ["nan"]


def test_strip_and_casefold(spark):
    df = _col(spark, ["\t Abc \n", "STRASSE", "Straße", None], "string")
    got = [tuple(r) for r in df.orderBy("i").select(T.trim_ws("x"), T.casefold("x"),
                                                   T.as_text("x", parity=True)).collect()]
    assert got[0][0] == "Abc"
    assert got[1][1] == got[2][1] == "strasse"
    assert got[3] == (None, None, "nan")


def test_nan_is_missing(spark):
    from forkcast.operators.profile import null_profile
    df = spark.createDataFrame([(1, float("nan")), (2, None), (3, 1.0)], "id int, x double")
    prof = {r["column_name"]: r["nulls"] for r in null_profile(df).collect()}
    assert prof["x"] == 2


def test_flags(spark):
    df = _col(spark, [1.0, 5.0, None])
    got = [tuple(r) for r in df.orderBy("i").select(S.flag_greater("x", F.lit(2.0)),
                                                   S.flag_at_least_keep_null("x", F.lit(2.0))).collect()]
    assert got == [(0, 0), (1, 1), (0, None)]


def test_strict_parse_fails_on_bad_text(spark):
    import pytest
    ok = _col(spark, ["['a']", None], "string").select(T.parse_list_strict("x").alias("v"))
    assert [r.v for r in ok.orderBy(F.col("v").isNull()).collect()] == [["a"], None]
    bad = _col(spark, ["['a']", "[bad"], "string").select(T.parse_list_strict("x"))
    with pytest.raises(Exception):
        bad.collect()


def test_sparse_form_makes_vectors(spark):
    from forkcast.operators import features
    df = spark.createDataFrame([(1, "['a', 'b']", "x", 1.0, 2.0, "Good"), (2, "['c', 'd']", "y", 3.0, 4.0, "Poor"),
                                (3, "['a']", "z", 5.0, 6.0, "Good"), (4, "['e']", "w", 7.0, 8.0, "Poor")],
                               "id long, cuisine string, subzone string, cost double, votes double, rating_text string")
    out = features.build_features(df, form="sparse")
    assert "cuisine_vec" in out.columns and "subzone_vec" in out.columns
    assert out.where("subzone_freq = 1").count() == 4


def test_kde_matches_direct_sum_with_gaps(spark):
    import math

    import numpy as np
    from forkcast.operators.explore import kde_curve
    vals = [0.0, 0.1, 0.2, 0.15, 100.0, 100.2, 99.9] * 50          # two clusters, empty middle
    df = spark.createDataFrame([(float(v),) for v in vals], "c double")
    got = sorted((r.grid, r.density) for r in kde_curve(df, "c", 50).collect())
    x = np.array(vals)
    n, h = len(x), np.std(x, ddof=1) * len(x) ** -0.2
    grid = np.linspace(x.min(), x.max(), 50)
    want = [np.exp(-0.5 * ((g - x) / h) ** 2).sum() / (n * h * math.sqrt(2 * math.pi)) for g in grid]
    assert len(got) == 50
    assert all(abs(d - round(w, 8)) < 2e-8 for (_, d), w in zip(got, want))


def test_dotted_categories_make_usable_columns(spark):
    from forkcast.operators import features, models
    df = spark.createDataFrame([(1, "['St. Kilda', 'Thai']", " St. Kilda", 2.0, 5.0, 3.1, "Good"),
                                (2, "['Cafe']", "CBD", 3.0, 6.0, 2.1, "Poor")] * 4,
                               "id long, cuisine string, subzone string, cost double, votes double, "
                               "rating_number double, rating_text string")
    out = features.build_features(df)
    assert "cuisine_St_ Kilda" in out.columns and "subzone_st_ kilda" in out.columns
    cols = models.feature_columns(out, {"id", "rating_number"})
    assert out.select(*cols).count() == 8                       # every name resolves


def test_feature_parity_for_missing_suburb(spark):
    from forkcast.operators import features
    df = spark.createDataFrame([(1, "['A']", None, 10.0, 1.0, "Good"), (2, "['B']", None, 20.0, 2.0, "Poor"),
                                (3, "['A']", "X", 30.0, 3.0, "Good")],
                               "id long, cuisine string, subzone string, cost double, votes double, rating_text string")
    default = {r.id: r for r in features.build_features(df).collect()}
    parity = {r.id: r for r in features.build_features(df, parity=True).collect()}
    assert "subzone_nan" not in features.build_features(df).columns
    assert parity[1]["subzone_nan"] is True and parity[3]["subzone_nan"] is False
    assert default[1].subzone_freq == 2 and parity[1].subzone_freq == 2      # NULLs form one group
    assert default[3].suburb_density == 1


def test_kde_without_spread_has_no_density(spark):
    from forkcast.operators.explore import kde_curve
    df = spark.createDataFrame([(5.0,), (5.0,), (None,)], "c double")
    rows = kde_curve(df, "c", 10, hist_bins=3).collect()
    assert len(rows) == 10 and all(r.density is None and r.count_curve is None for r in rows)


def test_format_and_coerce(spark):
    df = spark.createDataFrame([(0, 33.3333333, "12"), (1, 5.0, "x"), (2, None, None)], "i int, v double, s string")
    got = [tuple(r) for r in df.orderBy("i").select(S.fmt_percent("v"), S.fmt_fixed("v"),
                                                   S.to_int_or_zero("s")).collect()]
    assert got[0] == ("33.33%", "33.3333", 12)
    assert got[1] == ("5.00%", "5.0000", 0)
    assert got[2][2] == 0


def test_bin_index_orders_bins(spark):
    vals = [0.0, 19.99, 20.0, 499.99, 500.0, None]
    df = _col(spark, vals)
    left = [r[0] for r in df.orderBy("i").select(S.bin_index("x", S.EDA_COST_EDGES)).collect()]
    right = [r[0] for r in df.orderBy("i").select(S.bin_index("x", S.FEATURE_COST_EDGES, right=True)).collect()]
    assert left == [0, 0, 1, 4, None, None]
    assert right == [0, 0, 0, 3, 3, None]


def test_form_is_the_callers_choice(spark):
    """Thousands of categories: wide stays wide, sparse keeps every category."""
    from forkcast.operators import features
    rows = [(i, f"['c{i}', 'all']", None if i % 50 == 0 else f"s{i}") for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, cuisine string, subzone string")
    wide = features.multi_hot(df, "cuisine", keep_list=False)
    assert len(wide.columns) == 3 + 3000
    sparse = features.build_features(df.withColumn("rating_text", df.subzone), form="sparse")
    got = {r.id: r for r in sparse.select("id", "cuisine_vec", "subzone_vec").collect()}
    assert got[7].cuisine_vec.size == 3001 and got[7].cuisine_vec.numNonzeros() == 2
    assert got[7].subzone_vec.size == 2940 and got[50].subzone_vec.numNonzeros() == 0 and got[7].subzone_vec.numNonzeros() == 1


def test_ligature_is_folded_on_both_sides(spark):
    from forkcast.operators import geo
    venue = spark.createDataFrame([(1, "A", "['\ufb01sh']"), (2, "a ", "['\u1e9eX']")], "id long, subzone string, cuisine string")
    regions = spark.createDataFrame([("a",)], "region_name string")
    assert geo.cuisine_counts(venue, regions, "\ufb01sh").first().venue_count == 1
    many = {r.cuisine: r.venue_count for r in geo.cuisine_counts_many(venue, regions, ["\ufb01sh", "SSx"]).collect()}
    assert many == {"\ufb01sh": 1, "SSx": 1}


def test_no_rounding_inside_operators(spark):
    import numpy as np
    from forkcast.operators import explore
    for scale in (1e9, 1e-6):
        values = [scale * v for v in (1, 2, 2, 3, 7)]
        df = spark.createDataFrame([(v, "g") for v in values], "x double, g string")
        curve = explore.kde_curve(df, "x", 50).orderBy("grid").collect()
        h = np.std(values, ddof=1) * 5 ** -0.2
        want = [sum(np.exp(-0.5 * ((r.x - v) / h) ** 2) for v in values) / (5 * h * np.sqrt(2 * np.pi)) for r in curve]
        assert np.allclose([r.density for r in curve], want, rtol=1e-9) and min(want) > 0
        edges = [r.bin_lo for r in explore.histogram(df, "x", 30).orderBy("bin").collect()]
        assert np.allclose(edges, np.linspace(min(values), max(values), 31)[:-1], rtol=1e-12)
        grouped = explore.histogram_by_group(df, "x", "g", 30, ["g"]).orderBy("bin").collect()
        assert np.allclose([r.bin_lo for r in grouped], edges, rtol=1e-12) and sum(r.n for r in grouped) == 5
    assert explore.histogram_by_group(df, "x", "g", 30, ["none"]).collect() == []


def test_list_literals_like_python(spark):
    import ast
    from forkcast.functions import text
    good = ["['a', None, 'b']", "['a, None, b']", "('a', 'b')", "[]", "()", " [ 'a' , \"it's\" ,] ", "['\\x41\\\\x41', 'q\"q', \"d\\\"d\"]",
            "['tab\\t', 'l\\nb', '\\u00e9']", "[1, -2.5, 'x']", "['[x]', '(y']", "['" + "long " * 5000 + "']", "['raw\ttab\\\\']"]
    bad = ["not a list", "['Thai'", "['a' 'b',, ]", "['a']x", "[,]", ""]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(good + bad)], "id long, x string")
    got = {r.id: r.v for r in df.select("id", text.parse_list("x").alias("v")).collect()}
    for i, x in enumerate(good):
        assert got[i] == [None if v is None else str(v) for v in ast.literal_eval(x.strip())], x
    assert all(got[len(good) + i] is None for i in range(len(bad)))


def test_plain_and_broken_lists(spark):
    import pytest
    from forkcast.operators import explore, geo
    venue = spark.createDataFrame([(1, "a", "Thai"), (2, "a", "Thai"), (3, "a", "Cafe"), (4, "a", None)], "id long, subzone string, cuisine string")
    regions = spark.createDataFrame([("a",)], "region_name string")
    assert geo.cuisine_counts(venue, regions, "thai").first().venue_count == 2
    assert {r.item: r.n for r in explore.list_value_counts(venue, "cuisine").withColumnRenamed("cuisine", "item").collect()} == {"Thai": 2, "Cafe": 1}
    with pytest.raises(Exception, match="not a list literal"):
        explore.explode_list(venue.selectExpr("\"['Thai'\" as cuisine"), "cuisine").collect()


def test_binned_density_is_within_its_bound(spark):
    import numpy as np
    from forkcast.operators.explore import kde_curve_binned
    rng = np.random.default_rng(12)
    x = np.concatenate([rng.normal(0, 1, 3000), rng.normal(8, 0.1, 1000), [60.0]])
    df = spark.createDataFrame([(float(v),) for v in x] + [(None,), (float("nan"),)], "v double")
    h = x.std(ddof=1) * len(x) ** -0.2
    points = np.linspace(x.min(), x.max(), 50)
    want = np.exp(-0.5 * ((points[:, None] - x[None, :]) / h) ** 2).sum(1) / (len(x) * h * np.sqrt(2 * np.pi))
    for error in (1e-2, 1e-4, 1e-7):
        got = np.array([r.density for r in kde_curve_binned(df, "v", 50, error).orderBy("grid").collect()])
        assert np.abs(got - want).max() <= error / (h * np.sqrt(2 * np.pi)) + 1e-15
    assert [r.density for r in kde_curve_binned(df.limit(1), "v", 3).collect()] == [None] * 3
