"""Exploratory aggregates (AGG1-AGG10, AGG13, TOP1, ARR1-ARR2).

All are grouped aggregates with map-side partial aggregation, so a hot
key (one suburb or label holding a third of the rows) is reduced to one
row per task before the shuffle.  Per-group statistics that rows need
back (histogram ranges) are joined from the aggregated side, never taken
from a window partitioned by a possibly skewed key.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forkcast.functions.text import items_of, nan_to_null
from forkcast.session import materialize


def mean_by(df: DataFrame, key: str, col: str, alias: str | None = None) -> DataFrame:
    """``groupby(key)[col].mean()``; NULL keys dropped as pandas does."""
    return (df.where(F.col(key).isNotNull()).groupBy(key)
              .agg(F.avg(nan_to_null(F.col(col))).alias(alias or f"mean_{col}")))


def value_counts(df: DataFrame, col: str, count_col: str = "n") -> DataFrame:
    """``value_counts()``: non-null values with their counts."""
    return (df.where(F.col(col).isNotNull()).groupBy(col)
              .agg(F.count(F.lit(1)).alias(count_col)))


def top_n(counts: DataFrame, key: str, n: int, count_col: str = "n") -> DataFrame:
    """Top n by count, ties by key (TakeOrderedAndProject: a bounded
    per-task heap, no global sort)."""
    return counts.orderBy(F.desc(count_col), F.asc(key)).limit(n)


def explode_list(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """Flatten a list-literal column: one row per item (ARR1-ARR2).  Text
    that is no list is one item; a broken list fails the job."""
    out = out or col
    return df.select(F.explode(items_of(col)).alias(out)).where(F.col(out).isNotNull())


def list_value_counts(df: DataFrame, col: str, count_col: str = "n") -> DataFrame:
    """Item frequencies of a list-literal column, plus ``n_categories``
    (distinct items) and ``n_distinct_counts`` (what the reference prints
    as "unique": the number of distinct frequencies)."""
    counts = materialize(value_counts(explode_list(df, col, "item"), "item", count_col), "list-counts")
    n_cat = counts.select(F.count(F.lit(1))).scalar()
    n_freq = counts.select(F.count_distinct(count_col)).scalar()
    return counts.withColumns({"n_categories": n_cat, "n_distinct_counts": n_freq})


def crosstab(df: DataFrame, row_col: str, col_col: str, values: list[str]) -> DataFrame:
    """``pd.crosstab``: rows with NULL row or column value dropped; one
    count column per listed value (pivot with explicit values: no extra
    distinct job), zero filled."""
    base = df.where(F.col(row_col).isNotNull() & F.col(col_col).isin(values))
    piv = base.groupBy(row_col).pivot(col_col, values).agg(F.count(F.lit(1)))
    return piv.select(row_col, *[F.coalesce(F.col(v), F.lit(0)).cast("bigint").alias(v) for v in values])


def correlation(df: DataFrame, a: str, b: str) -> DataFrame:
    """Pearson correlation; pairs with a missing side are skipped."""
    return df.agg(F.corr(nan_to_null(F.col(a)), nan_to_null(F.col(b))).alias("corr"))


def histogram_by_group(df: DataFrame, value: str, group: str, bins: int = 20,
                       groups: list[str] | None = None) -> DataFrame:
    """Equal-width histogram per group over the group's own [min, max]
    (last bin closed, as numpy); every bin is listed, empty ones with 0.

    Columns: group, bin, bin_lo, bin_hi, n.  Per-group ranges are a small
    aggregate, written once.  Those of listed groups (as many as the caller
    names) become literals of a map lookup, so no row of a group is shuffled;
    otherwise they are joined back and their real size decides how."""
    x = nan_to_null(F.col(value))
    base = df.select(F.col(group).alias("g"), x.alias("x")).where(F.col("g").isNotNull() & F.col("x").isNotNull())
    if groups is not None:
        base = base.where(F.col("g").isin(groups))
    mm = base.groupBy("g").agg(F.min("x").alias("mn"), F.max("x").alias("mx"))
    same = F.col("mn") == F.col("mx")      # numpy widens a zero range by 0.5 each side
    rng = materialize(mm.select("g", F.when(same, F.col("mn") - 0.5).otherwise(F.col("mn")).cast("double").alias("lo"),
                                F.when(same, F.col("mx") + 0.5).otherwise(F.col("mx")).cast("double").alias("hi")), "group-ranges")
    if groups is not None:
        known = rng.collect()
        if not known:
            return df.sparkSession.createDataFrame([], df.select(group).schema).select(
                group, *[F.lit(None).cast(t).alias(c) for c, t in (("bin", "int"), ("bin_lo", "double"), ("bin_hi", "double"), ("n", "bigint"))])
        ranges = F.create_map(*[e for r in known for e in (F.lit(r["g"]), F.struct(F.lit(r["lo"]).alias("lo"), F.lit(r["hi"]).alias("hi")))])
        j = base.withColumn("_r", ranges[F.col("g")]).select("g", "x", "_r.lo", "_r.hi")
    else:
        j = base.join(rng, "g")
    idx = F.least(F.floor((F.col("x") - F.col("lo")) * F.lit(bins) / (F.col("hi") - F.col("lo"))),
                  F.lit(bins - 1)).cast("int")
    counts = j.groupBy("g", idx.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    grid = rng.select("g", "lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    w = (F.col("hi") - F.col("lo")) / F.lit(bins)
    out = grid.join(counts, ["g", "bin"], "left")
    return out.select(F.col("g").alias(group), "bin", (F.col("lo") + F.col("bin") * w).alias("bin_lo"),
                      (F.col("lo") + (F.col("bin") + 1) * w).alias("bin_hi"),
                      F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n"))


def histogram(df: DataFrame, value: str, bins: int = 30) -> DataFrame:
    """Equal-width histogram of one column over [min, max] (last bin
    closed); the range is a fitted pair of scalars (one pass), then one
    grouped count; every bin listed.  Columns: bin, bin_lo, bin_hi, n."""
    x = nan_to_null(F.col(value))
    base = df.select(x.alias("x")).where(F.col("x").isNotNull())
    mn, mx = base.agg(F.min("x"), F.max("x")).first()
    spark = df.sparkSession
    if mn is None:
        return spark.createDataFrame([], "bin int, bin_lo double, bin_hi double, n bigint")
    lo, hi = (mn - 0.5, mx + 0.5) if mn == mx else (mn, mx)
    lo_c, hi_c = F.lit(float(lo)), F.lit(float(hi))
    idx = F.least(F.floor((F.col("x") - lo_c) * F.lit(bins) / (hi_c - lo_c)), F.lit(bins - 1)).cast("int")
    counts = base.groupBy(idx.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    grid = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    w = (hi_c - lo_c) / F.lit(bins)
    return (grid.join(counts, "bin", "left")
                .select("bin", (lo_c + F.col("bin") * w).alias("bin_lo"), (lo_c + (F.col("bin") + 1) * w).alias("bin_hi"),
                        F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n")))


def kde_curve_binned(df: DataFrame, value: str, gridsize: int = 200, error: float = 1e-6) -> DataFrame:
    """``kde_curve`` of a continuous column, by linear binning: every value is
    shared out between the two ends of its cell, so what is multiplied by the
    grid is one row a cell, however many distinct values there are.

    A cell is h * sqrt(8 * error) wide.  Between its ends the kernel differs
    from the straight line by width^2 / 8 of its curvature at most, so every
    density is within error / (h * sqrt(2 pi)), ``error`` times the peak of a
    single value's kernel, of the direct sum.  Nulls and NaN count for nothing;
    without spread there is no density.  Columns: grid, x, density.
    """
    base = df.select(nan_to_null(F.col(value)).cast("double").alias("x")).where(F.col("x").isNotNull())
    st = base.agg(F.count(F.lit(1)).alias("n"), F.stddev_samp("x").alias("s"), F.min("x").alias("lo"), F.max("x").alias("hi")).first()
    grid = df.sparkSession.range(gridsize).select(F.col("id").cast("int").alias("grid"))
    if not st["s"]:
        return grid.select("grid", F.lit(st["lo"]).cast("double").alias("x"), F.lit(None).cast("double").alias("density"))
    h = st["s"] * st["n"] ** -0.2
    width, step, low = h * math.sqrt(8 * error), (st["hi"] - st["lo"]) / max(gridsize - 1, 1), F.lit(float(st["lo"]))
    place = (F.col("x") - low) / F.lit(width)
    cells = base.groupBy(F.floor(place).alias("cell")).agg(F.count(F.lit(1)).alias("n"), F.sum(place - F.floor(place)).alias("right"))
    at = low + F.col("grid") * F.lit(step)
    u = lambda cell: (at - low - cell * F.lit(width)) / F.lit(h)
    kernel = lambda cell: F.exp(F.lit(-0.5) * u(cell) * u(cell))
    shared = (F.col("n") - F.col("right")) * kernel(F.col("cell")) + F.col("right") * kernel(F.col("cell") + 1)
    sums = cells.select("cell", "n", "right", F.explode(F.sequence(F.lit(0), F.lit(gridsize - 1))).alias("grid")).groupBy("grid").agg(F.sum(shared).alias("k"))
    return grid.join(sums, "grid", "left").select("grid", at.alias("x"), (F.col("k") / F.lit(st["n"] * h * math.sqrt(2 * math.pi))).alias("density"))


def kde_curve(df: DataFrame, value: str, gridsize: int = 200, hist_bins: int | None = None) -> DataFrame:
    """Gaussian kernel density on an even grid over [min, max] with Scott's
    bandwidth h = std * n^(-1/5): f(g) = sum_i exp(-((g-x_i)/h)^2 / 2) /
    (n h sqrt(2 pi)), the whole kernel of every value.  Data are first reduced
    to (value, count) pairs; each Arrow batch of them then gives one row of
    ``gridsize`` sums (numpy), so nothing is multiplied by the grid before a
    shuffle.  Columns: grid, x, density, and with ``hist_bins`` also
    ``count_curve`` = density * n * bin width, the curve drawn over a
    ``hist_bins``-bin count histogram."""
    x = nan_to_null(F.col(value))
    base = df.select(x.cast("double").alias("x")).where(F.col("x").isNotNull())
    st = base.agg(F.count(F.lit(1)).alias("n"), F.stddev_samp("x").alias("s"),
                  F.min("x").alias("lo"), F.max("x").alias("hi")).first()     # fitted scalars, one pass
    n_, s_, lo_, hi_ = (F.lit(st[c]).cast("double") for c in ("n", "s", "lo", "hi"))
    grid = df.sparkSession.range(gridsize).select(F.col("id").cast("int").alias("grid"))   # every point listed
    if not st["s"]:                        # no spread (or < 2 values): no density, as the plot skips it
        cols = [F.col("grid"), F.lit(st["lo"]).cast("double").alias("x"), F.lit(None).cast("double").alias("density")]
        if hist_bins:
            cols.append(F.lit(None).cast("double").alias("count_curve"))
        return grid.select(*cols)
    width, low, step = st["s"] * st["n"] ** -0.2, st["lo"], (st["hi"] - st["lo"]) / (gridsize - 1)

    def kernel_sums(batches):
        import numpy as np
        import pyarrow as pa
        points = low + np.arange(gridsize) * step
        for batch in batches:
            total = np.zeros(gridsize)
            values, weights = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for i in range(0, len(values), 4096):
                z = (points[None, :] - values[i:i + 4096, None]) / width
                total += weights[i:i + 4096] @ np.exp(-0.5 * z * z)
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], names=["k"])

    sums = base.groupBy("x").agg(F.count(F.lit(1)).cast("double").alias("w")).mapInArrow(kernel_sums, "k array<double>")
    dens = sums.select(F.posexplode("k").alias("grid", "k")).groupBy("grid").agg(F.sum("k").alias("k"))
    out = grid.join(dens, "grid", "left").withColumn("k", F.coalesce(F.col("k"), F.lit(0.0)))
    h = s_ * F.pow(n_, F.lit(-0.2))
    dens_expr = F.col("k") / (n_ * h * F.lit(math.sqrt(2 * math.pi)))
    cols = [F.col("grid"), (lo_ + F.col("grid") * ((hi_ - lo_) / F.lit(gridsize - 1))).alias("x"), dens_expr.alias("density")]
    if hist_bins:
        cols.append((dens_expr * n_ * ((hi_ - lo_) / F.lit(hist_bins))).alias("count_curve"))
    return out.select(*cols)


def ordered_counts(df: DataFrame, col: str, order: list[str]) -> DataFrame:
    """``countplot(order=...)``: counts of the listed categories in list
    order, zero for absent ones, others dropped (AGG9, ORD1)."""
    cats = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(v).alias(col)) for i, v in enumerate(order)])
    counts = df.where(F.col(col).isin(order)).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    spine = counts.sparkSession.range(1).select(F.explode(cats).alias("c")).select("c.*")
    return (spine.join(counts, col, "left")
                 .select(F.col("position").cast("int"), col, F.coalesce("n", F.lit(0)).cast("bigint").alias("n")))


def column_totals(df: DataFrame, cols: list[str]) -> DataFrame:
    """``df[cols].sum(axis=0)`` as one row (AGG13)."""
    return df.agg(*[F.sum(c).alias(c) for c in cols])
