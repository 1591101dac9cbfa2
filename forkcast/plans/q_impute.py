"""k-NN imputation query (IMP2, JN3, JN4) and the full cleaning stage."""

from __future__ import annotations

from pyspark.sql import functions as F

from forkcast.operators import clean, knn
from forkcast.plans.oracle_views import with_views
from forkcast.plans.registry import register
from forkcast.sources.tables import venue_view

_FEATS = ["rating_number", "votes", "cost", "cost_2", "lat", "lng"]


def _knn_sql(t: str) -> str:
    m = " + ".join(f"CASE WHEN r.{c} IS NOT NULL AND d.{c} IS NOT NULL THEN 1 ELSE 0 END" for c in _FEATS)
    ss = " + ".join(f"coalesce(pow(r.{c} - d.{c}, 2), 0)" for c in _FEATS)
    return f"""
p_{t} AS (SELECT r.id AS rid, d.id AS did, d.{t} AS v, {m} AS m, {ss} AS ss
          FROM w r JOIN w d ON r.{t} IS NULL AND d.{t} IS NOT NULL),
k_{t} AS (SELECT rid, did, v, CASE WHEN m > 0 THEN sqrt({len(_FEATS)}.0 / m * ss) END AS dist,
                 row_number() OVER (PARTITION BY rid ORDER BY CASE WHEN m > 0 THEN sqrt({len(_FEATS)}.0 / m * ss) END
                                    NULLS LAST, did) AS rn FROM p_{t}),
a_{t} AS (SELECT rid, CASE WHEN count(dist) = 0 THEN (SELECT avg({t}) FROM w)
                           WHEN count(*) FILTER (WHERE dist = 0) > 0 THEN avg(v) FILTER (WHERE dist = 0)
                           ELSE sum(v / dist) FILTER (WHERE dist > 0) / sum(1.0 / dist) FILTER (WHERE dist > 0) END AS val
          FROM k_{t} WHERE rn <= 5 GROUP BY rid)"""


KNN_SQL = with_views(f""",
w AS (SELECT id, rating_number, votes, coalesce(cost, (SELECT median(cost) FROM venue)) AS cost,
             coalesce(cost_2, (SELECT median(cost_2) FROM venue)) AS cost_2, lat, lng FROM venue),
{_knn_sql('rating_number')},
{_knn_sql('votes')}
SELECT w.id, round(coalesce(w.rating_number, a_rating_number.val), 4) AS rating_number,
       round(coalesce(w.votes, a_votes.val), 4) AS votes, w.cost, w.cost_2, w.lat, w.lng
FROM w LEFT JOIN a_rating_number ON w.id = a_rating_number.rid LEFT JOIN a_votes ON w.id = a_votes.rid""")


@register("impute_knn", KNN_SQL)
def q_impute_knn(spark, d):
    v = clean.median_fill(venue_view(spark, d), ["cost", "cost_2"])
    out = knn.knn_impute(v, require_predictors=True)
    return out.select("id", F.round("rating_number", 4).alias("rating_number"),
                      F.round("votes", 4).alias("votes"), "cost", "cost_2", "lat", "lng")


def _band_sql(x: str) -> str:
    return (f"CASE WHEN {x} IS NULL THEN NULL WHEN {x} >= 4.5 THEN 'Excellent' WHEN {x} >= 4.0 THEN 'Very Good' "
            f"WHEN {x} >= 3.5 THEN 'Good' WHEN {x} >= 2.5 THEN 'Average' ELSE 'Poor' END")


CLEAN_SQL = with_views(f""",
w0 AS (SELECT id, subzone, cuisine, type, coalesce(cost, (SELECT median(cost) FROM venue)) AS cost,
              coalesce(cost_2, (SELECT median(cost_2) FROM venue)) AS cost_2, lat, lng, rating_number, votes,
              rating_text FROM venue),
w AS (SELECT id, rating_number, votes, cost, cost_2, lat, lng FROM w0),
{_knn_sql('rating_number')},
{_knn_sql('votes')},
imp AS (SELECT w0.* EXCLUDE (rating_number, votes),
               coalesce(w0.rating_number, a_rating_number.val) AS rating_number,
               coalesce(w0.votes, a_votes.val) AS votes
        FROM w0 LEFT JOIN a_rating_number ON w0.id = a_rating_number.rid LEFT JOIN a_votes ON w0.id = a_votes.rid),
kept AS (SELECT * FROM imp WHERE lat IS NOT NULL AND lng IS NOT NULL),
md AS (SELECT type FROM kept WHERE type IS NOT NULL GROUP BY type ORDER BY count(*) DESC, type LIMIT 1)
SELECT id, subzone, cuisine, coalesce(type, (SELECT type FROM md)) AS type, cost, cost_2, lat, lng,
       round(rating_number, 6) AS rating_number, round(votes, 6) AS votes,
       coalesce(rating_text, {_band_sql('rating_number')}) AS rating_text
FROM kept""")


@register("clean_stage", CLEAN_SQL)
def q_clean_stage(spark, d):
    from forkcast.plans import jobs
    out = jobs.clean_stage(venue_view(spark, d))
    return out.withColumns({"rating_number": F.round("rating_number", 6), "votes": F.round("votes", 6)})
