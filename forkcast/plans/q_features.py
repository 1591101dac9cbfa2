"""Feature queries (FE1-FE14, ARR3-ARR4, AGG13, JN2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from forkcast.functions.text import list_column, normalise_key
from forkcast.operators import dictionary, features
from forkcast.plans.oracle_views import strip, with_views
from forkcast.plans.registry import register
from forkcast.sources.tables import read_table, venue_view

_SPLIT = ("string_split(replace(replace({c}, '[' || chr(39), ''), chr(39) || ']', ''), "
          "chr(39) || ', ' || chr(39))")


# The fixture's categories (the same at every scale); only the
# SQL twins name them, the Spark side finds its own in the data.
ITEMS = ["anvil", "blue", "bolt", "cold", "gear", "gizmo", "hot", "large", "new", "old", "plate", "red", "ring", "rod",
         "small", "widget"]
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
SUBURBS = [f"nation_{i}" for i in range(25)]


def _flags_sql(prefix, values, items):
    """One 0/1 column per value of a list expression."""
    return ", ".join(f"CAST(coalesce(list_contains({items}, '{v}'), false) AS INTEGER) AS \"{prefix}_{v}\"" for v in values)


def _same_sql(prefix, values, expr):
    """One boolean column per value of a text expression."""
    return ", ".join(f"coalesce({expr} = '{v}', false) AS \"{prefix}_{v}\"" for v in values)


@register("multi_hot", with_views(f"""
, l AS (SELECT id, {_SPLIT.format(c='cuisine')} AS c_items, {_SPLIT.format(c='type')} AS t_items FROM venue)
SELECT id, {_flags_sql('cuisine', ITEMS, 'c_items')}, {_flags_sql('type', SEGMENTS, 't_items')} FROM l"""))
def q_multi_hot(spark, d):
    v = venue_view(spark, d).select("id", "cuisine", "type")
    out = features.multi_hot(v, "cuisine", keep_list=False)
    return features.multi_hot(out, "type", keep_list=False)


@register("cuisine_diversity", with_views(f"""
SELECT id, CAST(len(list_distinct({_SPLIT.format(c='cuisine')})) AS INTEGER) AS cuisine_diversity FROM venue"""))
def q_cuisine_diversity(spark, d):
    return features.diversity(venue_view(spark, d).select("id", "cuisine"), "cuisine").drop("cuisine")


@register("suburb_features", with_views(f"""
, v AS (SELECT id, lower({strip('subzone')}) AS subzone FROM venue),
f AS (SELECT subzone, count(*) AS subzone_freq FROM v GROUP BY subzone),
vf AS (SELECT v.id, v.subzone, CAST(f.subzone_freq AS BIGINT) AS subzone_freq FROM v JOIN f USING (subzone))
SELECT vf.id, vf.subzone_freq, vf.subzone_freq AS suburb_density,
       CAST(vf.subzone_freq * (1 + (SELECT sum(subzone_freq) FROM vf)) AS BIGINT) AS suburb_density_parity,
       {_same_sql('subzone', SUBURBS, 'vf.subzone')}
FROM vf"""))
def q_suburb_features(spark, d):
    v = venue_view(spark, d).select("id", normalise_key("subzone").alias("subzone"))
    out = features.group_frequency(v, "subzone", "subzone_freq")
    out = features.suburb_density(out)
    return features.one_hot_bool(out, "subzone").drop("subzone")


@register("votes_intensity", with_views("""
SELECT id, votes, CAST(coalesce(votes > (SELECT median(votes) FROM venue), false) AS INTEGER) AS votes_intensity
FROM venue"""))
def q_votes_intensity(spark, d):
    return features.votes_intensity(venue_view(spark, d).select("id", "votes"))


_LI = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _std_sql(fn):
    sel = ", ".join(
        f"round(CASE WHEN (SELECT {fn}({c}) FROM lineitem) = 0 THEN 0.0 ELSE "
        f"({c} - (SELECT avg({c}) FROM lineitem)) / (SELECT {fn}({c}) FROM lineitem) END, 6) AS z_{c}"
        for c in _LI)
    return f"SELECT l_orderkey, l_linenumber, {sel} FROM lineitem"


@register("standardise_pop", _std_sql("stddev_pop"))
def q_standardise_pop(spark, d):
    return features.standardise(read_table(spark, d, "lineitem"), _LI, ddof=0,
                                keep=["l_orderkey", "l_linenumber"], places=6)


@register("standardise_sample", _std_sql("stddev_samp"))
def q_standardise_sample(spark, d):
    return features.standardise(read_table(spark, d, "lineitem"), _LI, ddof=1,
                                keep=["l_orderkey", "l_linenumber"], places=6)


def _feature_sql():
    from forkcast.plans.q_impute import CLEAN_SQL
    items = "string_split(replace(replace({c}, '[' || chr(39), ''), chr(39) || ']', ''), chr(39) || ', ' || chr(39))"
    clean_body = CLEAN_SQL[CLEAN_SQL.index("w0 AS ("):]
    head, final_select = clean_body.rsplit("SELECT id, subzone, cuisine,", 1)
    return f"""WITH venue AS ({_venue_sql()}), {head.rstrip()},
cl AS (SELECT id, subzone, cuisine,{final_select}),
f AS (SELECT *, lower({strip('subzone')}) AS sz, {items.format(c='cuisine')} AS c_items,
             {items.format(c='type')} AS t_items FROM cl),
fq AS (SELECT sz, count(*) AS subzone_freq FROM f GROUP BY sz),
base AS (
  SELECT f.id, f.cost, f.cost_2, f.lat, f.lng, f.rating_number, f.votes,
    CAST(CASE f.rating_text WHEN 'Poor' THEN 1 WHEN 'Average' THEN 2 WHEN 'Good' THEN 3 WHEN 'Very Good' THEN 4
         WHEN 'Excellent' THEN 5 END AS INTEGER) AS rating_text_ord,
    CAST(fq.subzone_freq AS BIGINT) AS subzone_freq,
    CAST(len(list_distinct(f.c_items)) AS INTEGER) AS cuisine_diversity,
    CASE WHEN f.cost >= 0 AND f.cost <= 50 THEN 'Low' WHEN f.cost > 50 AND f.cost <= 100 THEN 'Medium'
         WHEN f.cost > 100 AND f.cost <= 200 THEN 'High' WHEN f.cost > 200 AND f.cost <= 500 THEN 'Luxury' END AS cost_bin,
    CAST(coalesce(f.votes > (SELECT median(votes) FROM f), false) AS INTEGER) AS votes_intensity,
    CAST(fq.subzone_freq AS BIGINT) AS suburb_density,
    CAST(fq.subzone_freq * (1 + (SELECT sum(q.subzone_freq) FROM f JOIN fq q USING (sz))) AS BIGINT)
      AS suburb_density_parity
  FROM f JOIN fq USING (sz))
SELECT base.*, {_flags_sql('cuisine', ITEMS, 'f.c_items')}, {_flags_sql('type', SEGMENTS, 'f.t_items')},
       {_same_sql('subzone', SUBURBS, 'f.sz')}
FROM base JOIN f USING (id)"""


def _venue_sql():
    from forkcast.plans.oracle_views import VENUE_SQL
    return VENUE_SQL


FEATURE_SQL = _feature_sql()


@register("feature_stage", FEATURE_SQL)
def q_feature_stage(spark, d):
    from forkcast.plans import jobs
    feats = jobs.feature_stage(jobs.clean_stage(venue_view(spark, d)))
    return feats.withColumns({"rating_number": F.round("rating_number", 6), "votes": F.round("votes", 6)})


@register("cuisine_totals", with_views(f"""
, l AS (SELECT {_SPLIT.format(c='cuisine')} AS items FROM venue)
SELECT {', '.join(f"CAST(count(*) FILTER (WHERE list_contains(items, '{v}')) AS BIGINT) AS cuisine_{v}" for v in ITEMS)} FROM l"""))
def q_cuisine_totals(spark, d):
    from forkcast.operators.clean import columns_with_prefix
    from forkcast.operators.explore import column_totals
    mh = features.multi_hot(venue_view(spark, d).select("id", "cuisine"), "cuisine", keep_list=False)
    cols = columns_with_prefix(mh, "cuisine_")                        # PRJ6
    tot = column_totals(mh, cols)                                       # AGG13
    return tot.select(*[F.col(c).cast("bigint").alias(c) for c in cols])


@register("cuisine_codes", with_views(f"""
, l AS (SELECT id, {_SPLIT.format(c='cuisine')} AS items FROM venue),
c AS (SELECT v, dense_rank() OVER (ORDER BY v) - 1 AS code FROM (SELECT DISTINCT unnest(items) AS v FROM l))
SELECT id, array_to_string(list_sort(list_distinct(list(code))), ',') AS codes FROM (SELECT id, unnest(items) AS v FROM l) JOIN c USING (v) GROUP BY id"""))
def q_cuisine_codes(spark, d):
    """ARR3: items of lists by code, codes in the items' order."""
    v = venue_view(spark, d).select("id", list_column("cuisine").alias("items"))
    known = dictionary.codes(v.select(F.explode("items").alias("v")), F.col("v"))
    coded = dictionary.encode_items(v, F.col("items"), known, "codes")
    return coded.select("id", F.array_join(F.col("codes").cast("array<string>"), ",").alias("codes"))


@register("customer_codes", "SELECT c_custkey, c_name, dense_rank() OVER (ORDER BY c_name) - 1 AS code FROM customer")
def q_customer_codes(spark, d):
    """FE2: a category column with a value per row or so."""
    c = read_table(spark, d, "customer").select("c_custkey", "c_name")
    return dictionary.encode(c, F.col("c_name"), dictionary.codes(c, F.col("c_name")), "code")
