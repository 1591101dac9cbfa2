"""Profiling (PRF1-PRF7): head, null profile, shape, types, describe.

Each profile is ONE aggregate pass (partial aggregation on every task,
a one-row final) followed by an unpivot to one row per column; the exact
quantiles of ``describe`` come from ``forkcast.operators.stats``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forkcast.functions.text import nan_to_null
from forkcast.operators.stats import exact_quantiles, grouped_exact_quantiles

# Fixed value: the numeric types models may use (decimal and boolean excluded).
NUMERIC_TYPES = ("double", "float", "int", "bigint", "smallint", "tinyint")


def numeric_columns(df: DataFrame, exclude: tuple = ()) -> list[str]:
    """Columns of a numeric type, in schema order (PRJ3)."""
    return [c for c, t in df.dtypes if t in NUMERIC_TYPES and c not in exclude]


def head_rows(df: DataFrame, n: int = 5, order_by: str = "id") -> DataFrame:
    """First n rows in key order (the positional index made explicit)."""
    return df.orderBy(order_by).limit(n)


def null_profile(df: DataFrame) -> DataFrame:
    """Per column: position, type, rows, nulls, non-nulls, null %, column count.

    A NaN in a floating column counts as missing, as in pandas."""
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for i, (c, t) in enumerate(df.dtypes):
        v = nan_to_null(F.col(c)) if t in ("double", "float") else F.col(c)
        aggs.append(F.count_if(v.isNull()).alias(f"n{i}"))
    one = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(c).alias("column_name"),
                              F.lit(t).alias("data_type"), F.col(f"n{i}").alias("nulls"))
                     for i, (c, t) in enumerate(df.dtypes)])
    out = one.select(F.col("__rows").alias("n_rows"), F.explode(rows).alias("r")).select("n_rows", "r.*")
    return out.select(
        F.col("position").cast("int").alias("position"), "column_name", "data_type",
        F.col("n_rows").cast("bigint").alias("n_rows"),
        F.col("nulls").cast("bigint").alias("nulls"),
        (F.col("n_rows") - F.col("nulls")).cast("bigint").alias("non_null"),
        F.round(F.when(F.col("n_rows") > 0, F.col("nulls") * 100.0 / F.col("n_rows")), 4).alias("null_pct"),
        F.lit(len(df.columns)).cast("int").alias("n_columns"))


def describe(df: DataFrame, cols: list[str] | None = None, places: int | None = 4) -> DataFrame:
    """``DataFrame.describe()``: count, mean, std (sample), min, 25%, 50%,
    75% (exact, interpolated), max per numeric column, one row per column.

    Not Spark's ``summary()``, whose percentiles are approximate and not
    interpolated."""
    cols = cols or numeric_columns(df)
    qs = exact_quantiles(df, cols, [0.25, 0.5, 0.75])
    clean = df.select(*[nan_to_null(F.col(c)).cast("double").alias(c) for c in cols])
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c)
        aggs += [F.count(x).alias(f"c{i}"), F.avg(x).alias(f"m{i}"), F.stddev_samp(x).alias(f"s{i}"),
                 F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
    one = clean.agg(*aggs)
    r = (lambda e: F.round(e, places)) if places is not None else (lambda e: e)
    rows = F.array(*[F.struct(
        F.lit(c).alias("column_name"), F.col(f"c{i}").cast("bigint").alias("count"),
        r(F.col(f"m{i}")).alias("mean"), r(F.col(f"s{i}")).alias("std"),
        r(F.col(f"lo{i}")).alias("min"),
        r(F.lit(qs[c][0]).cast("double")).alias("p25"), r(F.lit(qs[c][1]).cast("double")).alias("p50"),
        r(F.lit(qs[c][2]).cast("double")).alias("p75"),
        r(F.col(f"hi{i}")).alias("max")) for i, c in enumerate(cols)])
    return one.select(F.explode(rows).alias("r")).select("r.*")


def describe_by_group(df: DataFrame, key: str, col: str, places: int | None = 4) -> DataFrame:
    """``groupby(key)[col].describe()``: one row per non-null key.

    Moments are one grouped aggregate; the quartiles come from the
    grouped bounded exact-quantile search (any number of groups, a
    dominant group never in one task), joined on the key."""
    x = nan_to_null(F.col(col))
    r = (lambda e: F.round(e, places)) if places is not None else (lambda e: e)
    base = df.where(F.col(key).isNotNull())
    moments = base.groupBy(key).agg(F.count(x).cast("bigint").alias("count"), r(F.avg(x)).alias("mean"),
                                    r(F.stddev_samp(x)).alias("std"), r(F.min(x)).alias("min"),
                                    r(F.max(x)).alias("max"))
    q = grouped_exact_quantiles(base, key, col, [0.25, 0.5, 0.75])
    out = moments.join(q, key, "left")
    return out.select(key, "count", "mean", "std", "min", r(F.col("q0")).alias("p25"),
                      r(F.col("q1")).alias("p50"), r(F.col("q2")).alias("p75"), "max")


def shape(df: DataFrame) -> DataFrame:
    """(n_rows, n_columns)."""
    return df.agg(F.count(F.lit(1)).cast("bigint").alias("n_rows")).withColumn(
        "n_columns", F.lit(len(df.columns)).cast("int"))
