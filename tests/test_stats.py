"""Exact quantiles by bracketing equal numpy's linear interpolation."""

import numpy as np

from forkcast.operators.stats import exact_quantiles


def test_quantiles_match_numpy(spark):
    rng = np.random.default_rng(1)
    vals = np.concatenate([rng.normal(size=3000), np.full(2000, 0.25), rng.integers(0, 5, 1000)])
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    qs = [0.0, 0.25, 0.5, 0.75, 1.0]
    # a tiny exact budget forces several bracketing rounds
    got = exact_quantiles(df, ["x"], qs, accuracy=100, max_exact=50)["x"]
    assert np.allclose(got, np.quantile(vals, qs), rtol=0, atol=1e-12)


def test_quantiles_nulls_and_empty(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (3.0, None), (2.0, None)], "x double, y double")
    got = exact_quantiles(df, ["x", "y"], [0.5])
    assert got["x"] == [2.0] and got["y"] == [None]


def test_grouped_quantiles_match_numpy(spark):
    from forkcast.operators.stats import grouped_exact_quantiles
    rng = np.random.default_rng(5)
    rows = [("big", float(v)) for v in rng.normal(size=6000)]                 # dominant group
    rows += [("big", 0.5)] * 3000                                              # heavy repeated value
    rows += [("small", float(v)) for v in rng.integers(0, 10, 37)]
    rows += [("one", 4.0), ("nulls", None)]
    df = spark.createDataFrame(rows, "g string, x double")
    qs = [0.25, 0.5, 0.75]
    got = {r.g: [r.q0, r.q1, r.q2] for r in grouped_exact_quantiles(df, "g", "x", qs, accuracy=100,
                                                                     max_exact=40).collect()}
    for g in ("big", "small", "one"):
        vals = np.array([v for k, v in rows if k == g and v is not None])
        assert np.allclose(got[g], np.quantile(vals, qs), rtol=0, atol=1e-12), g
    assert "nulls" not in got


def test_heavy_values_at_any_size(spark):
    """Half the rows on either value, a heavy value ending at the rank, and a
    few hundred equally heavy values: nothing depends on the row count."""
    from pyspark.sql import functions as F

    from forkcast.operators.stats import grouped_exact_quantiles
    n = 1_000_000
    qs = [0.25, 0.5, 0.75]
    cols = {"half": "cast(id % 2 as double)", "ends": f"if(id < {n // 2}, 3.0d, cast(id as double))", "many": "cast(id % 521 as double)"}
    df = spark.range(n).selectExpr(*[f"{e} as {c}" for c, e in cols.items()])
    ids = np.arange(n)
    want = {"half": np.quantile(ids % 2, qs), "ends": np.quantile(np.where(ids < n // 2, 3.0, ids), qs), "many": np.quantile(ids % 521, qs)}
    got = exact_quantiles(df, list(cols), qs)
    for c in cols:
        assert np.allclose(got[c], want[c], rtol=0, atol=1e-9), c
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("g"), F.col(c).alias("x")) for c in cols])).alias("r")).select("r.*")
    for r in grouped_exact_quantiles(long, "g", "x", qs).collect():
        assert np.allclose([r.q0, r.q1, r.q2], want[r.g], rtol=0, atol=1e-9), r.g


def test_only_answers_are_collected(spark, monkeypatch):
    rows = []
    collect = type(spark.range(1)).collect
    monkeypatch.setattr(type(spark.range(1)), "collect", lambda self: rows.append(out := collect(self)) or out)
    df = spark.range(30_000).selectExpr("cast(id % 7000 as double) as x", "cast(id as double) as y")
    exact_quantiles(df, ["x", "y"], [0.25, 0.5, 0.75], accuracy=1000, max_exact=500)
    assert rows and max(map(len, rows)) <= 12
