"""Connected components of a table of links, by alternating stars.

A large star ties the larger neighbours of every node to its smallest
neighbour, a small star ties the smaller ones; repeated until nothing moves,
every node hangs on the smallest of its component.  Each step is a grouped
minimum (combined before the shuffle, so a node with very many links is one
row per task) and a join that AQE may split.  Steps are written to the shared
checkpoint folder; the driver sees one row of checksums a step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forkcast.session import materialize


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every id in ``links`` (a, b), ids being long.

    component is the smallest id reachable.  Repeated links, links of an id
    with itself and links in either direction are fine; links with a null
    end count for nothing; no links give no rows.
    """
    edges = (links.where("a is not null and b is not null and a <> b")
             .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    edges = materialize(edges, "links")
    last = None
    while True:
        sides = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = sides.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = sides.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
                 .unionAll(low.select("u", F.col("m").alias("v"))).distinct())
        edges = materialize(small, "star")
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == last:
            break
        last = now
    ids = edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return ids.unionAll(ids.select(F.col("component").alias("id"), "component").distinct())
