"""Exploratory aggregate queries (AGG1-AGG10, TOP1, ARR1-ARR2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from forkcast.functions import scalars as S
from forkcast.operators import explore
from forkcast.plans.oracle_views import with_views
from forkcast.plans.registry import register
from forkcast.sources.tables import read_table, venue_view

_ITEMS = ("unnest(string_split(replace(replace({c}, '[' || chr(39), ''), chr(39) || ']', ''), "
          "chr(39) || ', ' || chr(39)))")


@register("mean_by_label", with_views(
    "SELECT rating_text, round(avg(rating_number), 4) AS mean_rating_number FROM venue "
    "WHERE rating_text IS NOT NULL GROUP BY rating_text"))
def q_mean_by_label(spark, d):
    m = explore.mean_by(venue_view(spark, d), "rating_text", "rating_number")
    return m.withColumn("mean_rating_number", F.round("mean_rating_number", 4))


def _list_counts_sql(c):
    return with_views(f""", items AS (SELECT {_ITEMS.format(c=c)} AS item FROM venue WHERE {c} IS NOT NULL),
counts AS (SELECT item, count(*) AS n FROM items WHERE item IS NOT NULL GROUP BY item)
SELECT item, n, (SELECT count(*) FROM counts) AS n_categories,
       (SELECT count(DISTINCT n) FROM counts) AS n_distinct_counts FROM counts""")


@register("cuisine_value_counts", _list_counts_sql("cuisine"))
def q_cuisine_value_counts(spark, d):
    return explore.list_value_counts(venue_view(spark, d), "cuisine")


@register("type_value_counts", _list_counts_sql("type"))
def q_type_value_counts(spark, d):
    return explore.list_value_counts(venue_view(spark, d), "type")


def _top_items_sql(c, n):
    return with_views(f""", items AS (SELECT {_ITEMS.format(c=c)} AS item FROM venue WHERE {c} IS NOT NULL)
SELECT item, count(*) AS n FROM items WHERE item IS NOT NULL GROUP BY item ORDER BY n DESC, item LIMIT {n}""")


@register("top_cuisines", _top_items_sql("cuisine", 10))
def q_top_cuisines(spark, d):
    counts = explore.value_counts(explore.explode_list(venue_view(spark, d), "cuisine", "item"), "item")
    return explore.top_n(counts, "item", 10)


@register("top_types", _top_items_sql("type", 3))
def q_top_types(spark, d):
    counts = explore.value_counts(explore.explode_list(venue_view(spark, d), "type", "item"), "item")
    return explore.top_n(counts, "item", 3)


@register("top_suburbs", with_views(
    "SELECT subzone, count(*) AS n FROM venue WHERE subzone IS NOT NULL GROUP BY subzone "
    "ORDER BY n DESC, subzone LIMIT 3"))
def q_top_suburbs(spark, d):
    return explore.top_n(explore.value_counts(venue_view(spark, d), "subzone"), "subzone", 3)


@register("top_suburbs_5", with_views(
    "SELECT subzone, count(*) AS n FROM venue WHERE subzone IS NOT NULL GROUP BY subzone "
    "ORDER BY n DESC, subzone LIMIT 5"))
def q_top_suburbs_5(spark, d):
    return explore.top_n(explore.value_counts(venue_view(spark, d), "subzone"), "subzone", 5)


_BIN_LEFT_SQL = ("CASE WHEN cost >= 0 AND cost < 20 THEN '[0, 20)' WHEN cost >= 20 AND cost < 50 THEN '[20, 50)' "
                 "WHEN cost >= 50 AND cost < 100 THEN '[50, 100)' WHEN cost >= 100 AND cost < 200 THEN '[100, 200)' "
                 "WHEN cost >= 200 AND cost < 500 THEN '[200, 500)' END")


@register("cost_rating_crosstab", with_views(f"""
SELECT cost_bin, CAST(count(*) FILTER (WHERE rating_text = 'Excellent') AS BIGINT) AS Excellent,
       CAST(count(*) FILTER (WHERE rating_text = 'Poor') AS BIGINT) AS Poor
FROM (SELECT {_BIN_LEFT_SQL} AS cost_bin, rating_text FROM venue)
WHERE cost_bin IS NOT NULL AND rating_text IN ('Excellent', 'Poor') GROUP BY cost_bin"""))
def q_cost_rating_crosstab(spark, d):
    v = venue_view(spark, d).select(S.bin_left_closed("cost").alias("cost_bin"), "rating_text")
    return explore.crosstab(v, "cost_bin", "rating_text", ["Excellent", "Poor"])


@register("correlations", with_views("""
SELECT 'cost~votes' AS pair, round(corr(cost, votes), 6) AS corr FROM venue
UNION ALL SELECT 'cost~rating_number', round(corr(cost, rating_number), 6) FROM venue
UNION ALL SELECT 'quantity~extendedprice', round(corr(l_quantity, l_extendedprice), 6) FROM lineitem
UNION ALL SELECT 'discount~tax', round(corr(l_discount, l_tax), 6) FROM lineitem"""))
def q_correlations(spark, d):
    """Both pairs of a table in ONE aggregate pass (one scan per table)."""
    from forkcast.functions.text import nan_to_null
    v, li = venue_view(spark, d), read_table(spark, d, "lineitem")

    def pairs(df, spec):
        one = df.agg(*[F.corr(nan_to_null(F.col(a)), nan_to_null(F.col(b))).alias(f"c{i}")
                       for i, (a, b, _) in enumerate(spec)])
        rows = F.array(*[F.struct(F.lit(name).alias("pair"), F.round(F.col(f"c{i}"), 6).alias("corr"))
                         for i, (_, _, name) in enumerate(spec)])
        return one.select(F.explode(rows).alias("r")).select("r.*")
    return pairs(v, [("cost", "votes", "cost~votes"), ("cost", "rating_number", "cost~rating_number")]) \
        .unionByName(pairs(li, [("l_quantity", "l_extendedprice", "quantity~extendedprice"),
                                ("l_discount", "l_tax", "discount~tax")]))


def _hist_sql(value, group_expr, where, bins, group_name):
    return f"""
, base AS (SELECT {group_expr} AS g, {value} AS x FROM venue WHERE {where} AND {value} IS NOT NULL),
mm AS (SELECT g, min(x) AS mn, max(x) AS mx FROM base GROUP BY g),
rng AS (SELECT g, CASE WHEN mn = mx THEN mn - 0.5 ELSE mn END AS lo, CASE WHEN mn = mx THEN mx + 0.5 ELSE mx END AS hi FROM mm),
counts AS (SELECT b.g, CAST(least(floor((x - lo) * {bins} / (hi - lo)), {bins - 1}) AS INTEGER) AS bin, count(*) AS n
           FROM base b JOIN rng r ON b.g = r.g GROUP BY ALL),
grid AS (SELECT g, lo, hi, CAST(unnest(range(0, {bins})) AS INTEGER) AS bin FROM rng)
SELECT grid.g AS {group_name}, grid.bin, round(lo + grid.bin * ((hi - lo) / {bins}), 4) AS bin_lo,
       round(lo + (grid.bin + 1) * ((hi - lo) / {bins}), 4) AS bin_hi, CAST(coalesce(n, 0) AS BIGINT) AS n
FROM grid LEFT JOIN counts ON grid.g = counts.g AND grid.bin = counts.bin"""


@register("histogram_by_label", with_views(_hist_sql("cost", "rating_text", "rating_text IN ('Excellent', 'Poor')",
                                                     20, "rating_text")))
def q_histogram_by_label(spark, d):
    h = explore.histogram_by_group(venue_view(spark, d), "cost", "rating_text", 20, ["Excellent", "Poor"])
    return h.withColumns({c: F.round(c, 4) for c in ("bin_lo", "bin_hi")})


@register("cost_histogram", with_views(_hist_sql("cost", "'all'", "true", 30, "g").replace(
    "SELECT grid.g AS g, ", "SELECT ")))
def q_cost_histogram(spark, d):
    h = explore.histogram(venue_view(spark, d), "cost", 30)
    return h.withColumns({c: F.round(c, 4) for c in ("bin_lo", "bin_hi")})


@register("cost_density", with_views("""
, base AS (SELECT cost AS x FROM venue WHERE cost IS NOT NULL),
st AS (SELECT count(*) AS n, stddev_samp(x) AS s, min(x) AS lo, max(x) AS hi FROM base),
par AS (SELECT n, lo, hi, s * pow(CAST(n AS DOUBLE), -0.2) AS h, (hi - lo) / 199 AS step FROM st),
dist AS (SELECT x, count(*) AS w FROM base GROUP BY x),
grid AS (SELECT CAST(unnest(range(0, 200)) AS INTEGER) AS grid)
SELECT grid.grid, round(lo + grid.grid * step, 4) AS x,
       round(sum(w * exp(-0.5 * pow(((lo + grid.grid * step) - dist.x) / h, 2))) / (n * h * sqrt(2 * pi())), 8) AS density,
       round(sum(w * exp(-0.5 * pow(((lo + grid.grid * step) - dist.x) / h, 2))) / (n * h * sqrt(2 * pi()))
             * n * ((hi - lo) / 30), 6) AS count_curve
FROM grid CROSS JOIN dist CROSS JOIN par GROUP BY grid.grid, lo, hi, step, n, h"""))
def q_cost_density(spark, d):
    k = explore.kde_curve(venue_view(spark, d), "cost", 200, hist_bins=30)
    return k.withColumns({"x": F.round("x", 4), "density": F.round("density", 8), "count_curve": F.round("count_curve", 6)})


@register("rating_distribution", with_views("""
, cats(position, rating_text) AS (VALUES (0, 'Poor'), (1, 'Average'), (2, 'Good'), (3, 'Very Good'), (4, 'Excellent'))
SELECT CAST(c.position AS INTEGER) AS position, c.rating_text, CAST(coalesce(n, 0) AS BIGINT) AS n
FROM cats c LEFT JOIN (SELECT rating_text, count(*) AS n FROM venue GROUP BY rating_text) v
  ON c.rating_text = v.rating_text"""))
def q_rating_distribution(spark, d):
    return explore.ordered_counts(venue_view(spark, d), "rating_text", S.RATING_ORDER)


_BAND_SQL = ("CASE WHEN rating_number IS NULL THEN NULL WHEN rating_number >= 4.5 THEN 'Excellent' "
             "WHEN rating_number >= 4.0 THEN 'Very Good' WHEN rating_number >= 3.5 THEN 'Good' "
             "WHEN rating_number >= 2.5 THEN 'Average' ELSE 'Poor' END")


@register("mean_by_label_banded", with_views(f"""
SELECT rating_text, round(avg(rating_number), 4) AS mean_rating_number
FROM (SELECT {_BAND_SQL} AS rating_text, rating_number FROM venue)
WHERE rating_text IS NOT NULL GROUP BY rating_text"""))
def q_mean_by_label_banded(spark, d):
    """AGG1 after every label is re-derived from the number (IMP6): the
    reference's check that labels and numbers agree."""
    from forkcast.operators import clean
    v = clean.rating_band_fill(venue_view(spark, d), overwrite=True)
    m = explore.mean_by(v, "rating_text", "rating_number")
    return m.withColumn("mean_rating_number", F.round("mean_rating_number", 4))


@register("price_density", """
WITH s AS (SELECT count(*) AS n, stddev_samp(l_extendedprice) * pow(count(*), -0.2) AS h, min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem),
v AS (SELECT l_extendedprice AS x, count(*) AS w FROM lineitem WHERE l_extendedprice IS NOT NULL GROUP BY 1),
g AS (SELECT CAST(unnest(range(40)) AS INTEGER) AS grid, s.* FROM s)
SELECT grid, round(lo + grid * (hi - lo) / 39, 4) AS x, round(1e6 * sum(w * exp(-0.5 * pow((lo + grid * (hi - lo) / 39 - v.x) / h, 2))) / (any_value(n) * any_value(h) * sqrt(2 * pi())), 3) AS density_ppm
FROM g, v GROUP BY grid, lo, hi""")
def q_price_density(spark, d):
    """AGG8 on a continuous column; the SQL sums every value's kernel."""
    k = explore.kde_curve_binned(read_table(spark, d, "lineitem"), "l_extendedprice", 40, error=1e-9)
    return k.select("grid", F.round("x", 4).alias("x"), F.round(F.col("density") * 1e6, 3).alias("density_ppm"))
