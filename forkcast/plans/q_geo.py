"""Region counts per cuisine (GEO2, GEO3, JN1, AGG4, AGG10)."""

from __future__ import annotations

from forkcast.operators import geo
from forkcast.plans.oracle_views import fold, strip, with_views
from forkcast.plans.registry import register
from forkcast.sources.tables import boundaries_view, venue_view


# The cuisines asked about (one, then the list of eight),
# mixed case on purpose to exercise the case-insensitive match.
FLAGSHIP_CUISINE = "Widget"
CUISINE_LIST = ["Widget", "Gear", "Bolt", "Ring", "Plate", "Rod", "Anvil", "Gizmo"]

# SQL: the long (subzone, cuisine) table of the venue view
_LONG_SQL = f"""
long AS (
  SELECT lower({strip('subzone')}) AS subzone, {strip('item')} AS cuisine
  FROM (SELECT subzone, unnest(string_split(replace(replace(cuisine, '[' || chr(39), ''), chr(39) || ']', ''),
                                            chr(39) || ', ' || chr(39))) AS item FROM venue)
  WHERE subzone IS NOT NULL AND item IS NOT NULL)
"""


@register("cuisine_counts", with_views(f""", {_LONG_SQL}
SELECT b.region_id, b.min_x, b.max_x, b.min_y, b.max_y, {strip('b.region_name')} AS region_name,
       CAST(coalesce(c.venue_count, 0) AS BIGINT) AS venue_count
FROM boundaries b
LEFT JOIN (SELECT subzone, count(*) AS venue_count FROM long
           WHERE {fold('cuisine')} = {fold(repr(FLAGSHIP_CUISINE))} GROUP BY subzone) c
  ON lower({strip('b.region_name')}) = c.subzone
"""))
def q_cuisine_counts(spark, d):
    return geo.cuisine_counts(venue_view(spark, d), boundaries_view(spark, d), FLAGSHIP_CUISINE)


_CUISINE_VALUES = ", ".join(f"('{c}')" for c in CUISINE_LIST)


@register("cuisine_counts_all", with_views(f""", {_LONG_SQL},
counts AS (SELECT subzone, {fold('cuisine')} AS f, count(*) AS venue_count FROM long
           WHERE {fold('cuisine')} IN ({", ".join(fold(repr(c)) for c in CUISINE_LIST)})
           GROUP BY 1, 2),
names(cuisine) AS (VALUES {_CUISINE_VALUES}),
joined AS (
  SELECT b.region_id, b.min_x, b.max_x, b.min_y, b.max_y, {strip('b.region_name')} AS region_name,
         n.cuisine, CAST(coalesce(c.venue_count, 0) AS BIGINT) AS venue_count
  FROM boundaries b CROSS JOIN names n
  LEFT JOIN counts c ON lower({strip('b.region_name')}) = c.subzone AND {fold('n.cuisine')} = c.f)
SELECT *, CAST(greatest(1, coalesce((SELECT max(venue_count) FROM joined), 0)) AS BIGINT) AS global_max
FROM joined
"""))
def q_cuisine_counts_all(spark, d):
    return geo.cuisine_counts_many(venue_view(spark, d), boundaries_view(spark, d), CUISINE_LIST)
