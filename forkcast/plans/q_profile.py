"""Profiling queries (PRF1-PRF7)."""

from __future__ import annotations

from forkcast.operators import profile
from forkcast.plans.oracle_views import with_views
from forkcast.plans.registry import register
from forkcast.sources.tables import read_table, venue_view

# Venue columns and their Spark type names, in view order.
VENUE_TYPES = [("id", "bigint"), ("subzone", "string"), ("cuisine", "string"), ("type", "string"),
               ("cost", "double"), ("cost_2", "double"), ("lat", "double"), ("lng", "double"),
               ("rating_number", "double"), ("votes", "double"), ("rating_text", "string")]
LINEITEM_NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("head_rows", with_views("SELECT * FROM venue ORDER BY id LIMIT 5"))
def q_head_rows(spark, d):
    return profile.head_rows(venue_view(spark, d), 5, "id")


def _null_profile_sql():
    parts = []
    for i, (c, t) in enumerate(VENUE_TYPES):
        parts.append(f"""SELECT CAST({i} AS INTEGER) AS position, '{c}' AS column_name, '{t}' AS data_type,
  CAST(count(*) AS BIGINT) AS n_rows, CAST(count(*) - count({c}) AS BIGINT) AS nulls,
  CAST(count({c}) AS BIGINT) AS non_null,
  round(CAST(count(*) - count({c}) AS DOUBLE) * 100.0 / count(*), 4) AS null_pct,
  CAST({len(VENUE_TYPES)} AS INTEGER) AS n_columns FROM venue""")
    return with_views("\nUNION ALL\n".join(parts))


@register("null_profile", _null_profile_sql())
def q_null_profile(spark, d):
    return profile.null_profile(venue_view(spark, d))


def _describe_sql(table, cols):
    parts = []
    for c in cols:
        parts.append(f"""SELECT '{c}' AS column_name, CAST(count({c}) AS BIGINT) AS count,
  round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, round(min({c}), 4) AS min,
  round(quantile_cont({c}, 0.25), 4) AS p25, round(quantile_cont({c}, 0.5), 4) AS p50,
  round(quantile_cont({c}, 0.75), 4) AS p75, round(max({c}), 4) AS max FROM {table}""")
    return "\nUNION ALL\n".join(parts)


@register("describe_numeric", _describe_sql("lineitem", LINEITEM_NUMERIC))
def q_describe_numeric(spark, d):
    return profile.describe(read_table(spark, d, "lineitem"), LINEITEM_NUMERIC)


@register("describe_venue", with_views(_describe_sql("venue", ["cost", "cost_2", "lat", "lng",
                                                                "rating_number", "votes"])))
def q_describe_venue(spark, d):
    return profile.describe(venue_view(spark, d), ["cost", "cost_2", "lat", "lng", "rating_number", "votes"])


@register("describe_by_group", with_views("""
SELECT rating_text, CAST(count(cost) AS BIGINT) AS count, round(avg(cost), 4) AS mean,
  round(stddev_samp(cost), 4) AS std, round(min(cost), 4) AS min,
  round(quantile_cont(cost, 0.25), 4) AS p25, round(quantile_cont(cost, 0.5), 4) AS p50,
  round(quantile_cont(cost, 0.75), 4) AS p75, round(max(cost), 4) AS max
FROM venue WHERE rating_text IS NOT NULL GROUP BY rating_text"""))
def q_describe_by_group(spark, d):
    return profile.describe_by_group(venue_view(spark, d), "rating_text", "cost")


@register("shape", with_views(f"SELECT CAST(count(*) AS BIGINT) AS n_rows, "
                              f"CAST({len(VENUE_TYPES)} AS INTEGER) AS n_columns FROM venue"))
def q_shape(spark, d):
    return profile.shape(venue_view(spark, d))
