"""Cleaning, filter, projection and scalar-function queries
(IMP1, IMP3-IMP6, FLT1-FLT8, PRJ1-PRJ7, SCL1-SCL16)."""

from __future__ import annotations

from pyspark.sql import functions as F

from forkcast.functions import scalars as S
from forkcast.functions import text as T
from forkcast.operators import clean, profile
from forkcast.plans.oracle_views import fold, strip, with_views
from forkcast.plans.registry import register
from forkcast.sources.tables import venue_view

VENUE_COLS = ["id", "subzone", "cuisine", "type", "cost", "cost_2", "lat", "lng",
              "rating_number", "votes", "rating_text"]


def _sel(replace: dict) -> str:
    return ", ".join(f"{replace[c]} AS {c}" if c in replace else c for c in VENUE_COLS)


def _band_sql(x: str) -> str:
    return (f"CASE WHEN {x} IS NULL THEN NULL WHEN {x} >= 4.5 THEN 'Excellent' WHEN {x} >= 4.0 THEN 'Very Good' "
            f"WHEN {x} >= 3.5 THEN 'Good' WHEN {x} >= 2.5 THEN 'Average' ELSE 'Poor' END")


@register("impute_median", with_views("SELECT " + _sel({
    "cost": "coalesce(cost, (SELECT median(cost) FROM venue))",
    "cost_2": "coalesce(cost_2, (SELECT median(cost_2) FROM venue))"}) + " FROM venue"))
def q_impute_median(spark, d):
    return clean.median_fill(venue_view(spark, d), ["cost", "cost_2"])


_MODE_SQL = "(SELECT type FROM venue WHERE type IS NOT NULL GROUP BY type ORDER BY count(*) DESC, type LIMIT 1)"


@register("impute_mode", with_views("SELECT " + _sel({"type": f"coalesce(type, {_MODE_SQL})"}) + " FROM venue"))
def q_impute_mode(spark, d):
    return clean.mode_fill(venue_view(spark, d), "type")


@register("drop_missing_location", with_views("SELECT * FROM venue WHERE lat IS NOT NULL AND lng IS NOT NULL"))
def q_drop_missing_location(spark, d):
    return clean.drop_missing(venue_view(spark, d), ["lat", "lng"])


@register("rating_band_fill", with_views("SELECT " + _sel(
    {"rating_text": f"coalesce(rating_text, {_band_sql('rating_number')})"}) + " FROM venue"))
def q_rating_band_fill(spark, d):
    return clean.rating_band_fill(venue_view(spark, d), overwrite=False)


@register("rating_band_all", with_views("SELECT " + _sel({"rating_text": _band_sql("rating_number")}) + " FROM venue"))
def q_rating_band_all(spark, d):
    return clean.rating_band_fill(venue_view(spark, d), overwrite=True)


@register("filter_in", with_views("SELECT * FROM venue WHERE rating_text IN ('Excellent', 'Poor')"))
def q_filter_in(spark, d):
    return clean.where_in(venue_view(spark, d), "rating_text", ["Excellent", "Poor"])


@register("filter_equals", with_views("SELECT * FROM venue WHERE rating_text = 'Excellent'"))
def q_filter_equals(spark, d):
    return clean.where_equals(venue_view(spark, d), "rating_text", "Excellent")


@register("filter_casefold", with_views(
    f"SELECT * FROM venue WHERE {fold(strip('subzone'))} = {fold(repr('NATION_3'))}"))
def q_filter_casefold(spark, d):
    v = venue_view(spark, d).withColumn("_name", T.trim_ws("subzone"))
    return clean.where_casefold_equals(v, "_name", "NATION_3").drop("_name")


@register("drop_null_subset", with_views(
    "SELECT * FROM venue WHERE rating_number IS NOT NULL AND votes IS NOT NULL"))
def q_drop_null_subset(spark, d):
    return clean.drop_missing(venue_view(spark, d), ["rating_number", "votes"])


@register("drop_null_any", with_views("SELECT * FROM venue WHERE " + " AND ".join(
    f"{c} IS NOT NULL" for c in VENUE_COLS)))
def q_drop_null_any(spark, d):
    return clean.drop_any_null(venue_view(spark, d))


@register("any_list_like", with_views(
    "SELECT coalesce(bool_or(starts_with(cuisine, '[')), false) AS cuisine_list_like, "
    "coalesce(bool_or(starts_with(subzone, '[')), false) AS subzone_list_like FROM venue"))
def q_any_list_like(spark, d):
    v = venue_view(spark, d)
    return spark.range(1).select(clean.any_starts_with(v, "cuisine").alias("cuisine_list_like"),
                                 clean.any_starts_with(v, "subzone").alias("subzone_list_like"))


@register("min_rows_guard", with_views(
    "SELECT (SELECT count(*) FROM (SELECT id FROM venue LIMIT 5)) >= 5 AS has_min_rows, "
    "(SELECT count(*) FROM (SELECT id FROM venue WHERE rating_text = 'none' LIMIT 5)) >= 5 AS has_min_rows_empty"))
def q_min_rows_guard(spark, d):
    v = venue_view(spark, d)
    none = v.where(F.col("rating_text") == "none")
    return spark.range(1).select(F.lit(clean.has_min_rows(v)).alias("has_min_rows"), F.lit(clean.has_min_rows(none)).alias("has_min_rows_empty"))


@register("project_drop", with_views(
    "SELECT cost, cost_2, lat, lng, rating_number, votes, "
    "coalesce(CAST(trunc(votes) AS INTEGER), 0) AS votes_int, CAST(NULL AS INTEGER) AS rating_binary FROM venue"))
def q_project_drop(spark, d):
    v = venue_view(spark, d)
    num = v.select(*profile.numeric_columns(v))                     # PRJ3
    num = clean.drop_columns(num, ["id", "not_a_column"])            # PRJ4
    num = num.withColumn("votes_int", S.to_int_or_zero(F.col("votes")))   # SCL11
    return clean.with_null_column(num, "rating_binary", "int")       # PRJ5


@register("normalise_text", with_views(f"""
SELECT id, lower({strip('subzone')}) AS subzone_key, coalesce(CAST(subzone AS VARCHAR), 'nan') AS subzone_text,
  {strip('subzone')} || ': ' || CAST(id AS VARCHAR) AS label, {fold(strip('subzone'))} AS subzone_fold,
  starts_with({strip('cuisine')}, '[') AS cuisine_list_like
FROM venue"""))
def q_normalise_text(spark, d):
    v = venue_view(spark, d)
    return v.select("id", T.normalise_key("subzone").alias("subzone_key"),
                    T.as_text("subzone", parity=True).alias("subzone_text"),
                    F.concat(T.trim_ws("subzone"), F.lit(": "), F.col("id").cast("string")).alias("label"),
                    T.casefold(T.trim_ws("subzone")).alias("subzone_fold"),
                    T.trim_ws("cuisine").startswith("[").alias("cuisine_list_like"))


def _items_sql(c: str) -> str:
    return (f"string_split(replace(replace({c}, '[' || chr(39), ''), chr(39) || ']', ''), "
            f"chr(39) || ', ' || chr(39))")


@register("parse_lists", with_views(f"""
SELECT id, array_to_string({_items_sql('cuisine')}, '|') AS cuisine_items,
  CAST(len({_items_sql('cuisine')}) AS INTEGER) AS n_cuisine,
  CASE WHEN type IS NULL THEN NULL ELSE array_to_string({_items_sql('type')}, '|') END AS type_items,
  CASE WHEN type IS NULL THEN 'nan' ELSE array_to_string({_items_sql('type')}, '|') END AS type_items_parity
FROM venue"""))
def q_parse_lists(spark, d):
    v = venue_view(spark, d)
    cu = T.list_column("cuisine")
    ty = T.list_column("type")
    return v.select("id", F.concat_ws("|", cu).alias("cuisine_items"), F.size(cu).cast("int").alias("n_cuisine"),
                    F.when(ty.isNotNull(), F.concat_ws("|", ty)).alias("type_items"),
                    F.concat_ws("|", T.list_column("type", parity=True)).alias("type_items_parity"))


@register("map_labels", with_views("""
SELECT id, rating_text,
  CAST(CASE rating_text WHEN 'Poor' THEN 1 WHEN 'Average' THEN 2 WHEN 'Good' THEN 3 WHEN 'Very Good' THEN 4
       WHEN 'Excellent' THEN 5 END AS INTEGER) AS rating_text_ord,
  CAST(CASE WHEN rating_text IN ('Poor', 'Average') THEN 0 WHEN rating_text IN ('Good', 'Very Good', 'Excellent')
       THEN 1 END AS INTEGER) AS rating_binary
FROM venue"""))
def q_map_labels(spark, d):
    v = venue_view(spark, d)
    return v.select("id", "rating_text", S.rating_ordinal("rating_text").alias("rating_text_ord"),
                    S.rating_binary("rating_text").alias("rating_binary"))


@register("cost_bins_left", with_views("""
SELECT id, cost, CASE WHEN cost >= 0 AND cost < 20 THEN '[0, 20)' WHEN cost >= 20 AND cost < 50 THEN '[20, 50)'
  WHEN cost >= 50 AND cost < 100 THEN '[50, 100)' WHEN cost >= 100 AND cost < 200 THEN '[100, 200)'
  WHEN cost >= 200 AND cost < 500 THEN '[200, 500)' END AS cost_bin FROM venue"""))
def q_cost_bins_left(spark, d):
    v = venue_view(spark, d)
    return v.select("id", "cost", S.bin_left_closed("cost").alias("cost_bin"))


@register("cost_bins_right", with_views("""
SELECT id, cost, CASE WHEN cost >= 0 AND cost <= 50 THEN 'Low' WHEN cost > 50 AND cost <= 100 THEN 'Medium'
  WHEN cost > 100 AND cost <= 200 THEN 'High' WHEN cost > 200 AND cost <= 500 THEN 'Luxury' END AS cost_bin
FROM venue"""))
def q_cost_bins_right(spark, d):
    v = venue_view(spark, d)
    return v.select("id", "cost", S.bin_right_closed("cost").alias("cost_bin"))


@register("format_metrics", with_views("""
SELECT printf('%.2f', CAST(count(*) - count(rating_number) AS DOUBLE) * 100.0 / count(*)) || '%' AS rating_missing_pct,
  printf('%.2f', CAST(count(*) - count(cost) AS DOUBLE) * 100.0 / count(*)) || '%' AS cost_missing_pct,
  round(CAST(count(*) - count(votes) AS DOUBLE) * 100.0 / count(*), 4) AS votes_missing_pct,
  printf('%.4f', CAST(count(lat) AS DOUBLE) / count(*)) AS lat_present_ratio
FROM venue"""))
def q_format_metrics(spark, d):
    v = venue_view(spark, d)
    n = F.count(F.lit(1))
    miss = lambda c: (n - F.count(c)).cast("double") * F.lit(100.0) / n
    return v.agg(S.fmt_percent(miss("rating_number")).alias("rating_missing_pct"),
                 S.fmt_percent(miss("cost")).alias("cost_missing_pct"),
                 F.round(miss("votes"), 4).alias("votes_missing_pct"),
                 S.fmt_fixed(F.count("lat").cast("double") / n).alias("lat_present_ratio"))


_PREDICATES = [
    ("in", "rating_text IN ('Excellent', 'Poor')"),
    ("equals", "rating_text = 'Excellent'"),
    ("casefold", f"{fold(strip('subzone'))} = {fold(repr('NATION_3'))}"),
    ("drop_null_subset", "rating_number IS NOT NULL AND votes IS NOT NULL"),
    ("drop_null_any", " AND ".join(f"{c} IS NOT NULL" for c in VENUE_COLS)),
]


@register("filter_predicates", with_views("\nUNION ALL\n".join(
    f"SELECT '{name}' AS predicate, * FROM venue WHERE {cond}" for name, cond in _PREDICATES)))
def q_filter_predicates(spark, d):
    """FLT1-FLT5 in ONE scan: each row is emitted once per predicate it
    passes (a filtered array of labels, exploded)."""
    from functools import reduce
    v = venue_view(spark, d)
    conds = [("in", F.col("rating_text").isin("Excellent", "Poor")),
             ("equals", F.col("rating_text") == "Excellent"),
             ("casefold", T.casefold(T.trim_ws("subzone")) == T.casefold(F.lit("NATION_3"))),
             ("drop_null_subset", F.col("rating_number").isNotNull() & F.col("votes").isNotNull()),
             ("drop_null_any", reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in VENUE_COLS]))]
    labels = F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(name)) for name, c in conds])
    return v.select(F.explode(F.filter(labels, lambda x: x.isNotNull())).alias("predicate"), *VENUE_COLS)
