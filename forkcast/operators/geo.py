"""Region counts and boundary operators (GEO1-GEO4, JN1, AGG10, AGG14).

The reference loops over cuisines, re-filtering the exploded table and
re-joining the boundaries for each; here one grouped pass over the long
table feeds a single left join, and only rows whose list text may mention
a requested cuisine are parsed and exploded (an exact superset test on
the raw text).  Counts per (suburb, cuisine) are at most
the number of distinct suburbs x requested cuisines, and the boundary
table is one row per region: AQE broadcasts whichever side is under the
broadcast threshold at run time and falls back to a shuffle join above it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forkcast.functions.text import casefold, items_of, normalise_key, trim_ws
from forkcast.session import materialize

EARTH_RADIUS_M = 6378137.0  # fixed value: WGS84 / web-mercator sphere radius


def long_cuisines(venue: DataFrame, parity: bool = False) -> DataFrame:
    """One row per venue x cuisine item: (subzone, cuisine).

    Suburb names are normalised (strip + lower), list text is parsed and
    exploded; NULL items and rows are dropped and items stripped.  Text that
    is no list is one item; a broken list fails the job."""
    return (venue
            .select(normalise_key("subzone", parity).alias("subzone"),
                    F.explode(items_of("cuisine")).alias("cuisine"))
            .where(F.col("subzone").isNotNull() & F.col("cuisine").isNotNull())
            .select("subzone", trim_ws("cuisine").alias("cuisine")))


def _may_mention(text: Column, names: list[str]) -> Column:
    """Cheap superset test run before parsing: the folded list text contains
    a name folded by the same expression, or holds a backslash escape (where
    the raw text can differ from the parsed item).  Rows failing it cannot
    match, so only candidate rows are parsed and exploded."""
    folded = casefold(text)
    hit = F.lit(False)
    for n in names:
        hit = hit | folded.contains(casefold(F.lit(n)))
    return hit | text.contains("\\")


def _region_key(boundaries: DataFrame, name_col: str) -> Column:
    return normalise_key(name_col)


def cuisine_counts(venue: DataFrame, boundaries: DataFrame, cuisine: str,
                   name_col: str = "region_name", parity: bool = False) -> DataFrame:
    """Venues serving ``cuisine`` (case-insensitive) per boundary region,
    zero for regions without any; every boundary row is kept (duplicates
    included).  Columns: boundary columns with ``name_col`` stripped, plus
    ``venue_count`` BIGINT."""
    counts = (long_cuisines(venue.where(_may_mention(F.col("cuisine"), [cuisine])), parity)
              .where(casefold("cuisine") == casefold(F.lit(cuisine)))
              .groupBy("subzone").agg(F.count(F.lit(1)).alias("venue_count")))
    regions = boundaries.withColumn("_key", _region_key(boundaries, name_col))
    out = regions.join(counts, regions["_key"] == counts["subzone"], "left")
    keep = [F.col(c) for c in boundaries.columns if c != name_col]
    return out.select(*keep, trim_ws(F.col(name_col)).alias(name_col),
                      F.coalesce(F.col("venue_count"), F.lit(0)).cast("bigint").alias("venue_count"))


def cuisine_counts_many(venue: DataFrame, boundaries: DataFrame, cuisines: list[str],
                        name_col: str = "region_name", parity: bool = False) -> DataFrame:
    """``cuisine_counts`` for a list of cuisines in one grouped pass, long
    form (one row per region x cuisine), plus ``global_max`` =
    max(1, largest count among the region rows) shared by all rows (a
    scalar subquery over the small joined table)."""
    folded = [casefold(F.lit(c)) for c in cuisines]
    counts = (long_cuisines(venue.where(_may_mention(F.col("cuisine"), cuisines)), parity)
              .withColumn("_fold", casefold("cuisine"))
              .where(F.col("_fold").isin(*folded))
              .groupBy("subzone", "_fold").agg(F.count(F.lit(1)).alias("venue_count")))
    # counts are tiny (suburbs x listed cuisines) and read twice (join and
    # shared maximum): write them once so the venue table is scanned once
    counts = materialize(counts, "cuisine-counts")
    # the cuisine list is a fixed literal: expand regions by explode, no join
    pairs = F.array(*[F.struct(F.lit(c).alias("cuisine"), f.alias("_fold"))
                      for c, f in zip(cuisines, folded)])
    regions = (boundaries
               .withColumn("_key", _region_key(boundaries, name_col))
               .withColumn("_c", F.explode(pairs))
               .select("*", "_c.cuisine", "_c._fold").drop("_c"))
    j = regions.join(counts, (regions["_key"] == counts["subzone"]) & (regions["_fold"] == counts["_fold"]), "left")
    keep = [F.col(c) for c in boundaries.columns if c != name_col]
    long = j.select(*keep, trim_ws(F.col(name_col)).alias(name_col), F.col("cuisine"),
                    F.coalesce(F.col("venue_count"), F.lit(0)).cast("bigint").alias("venue_count"))
    # the shared colour scale: max(1, largest count over the JOINED rows), so
    # a suburb missing from the boundaries never sets it; read from the counts
    # of the regions' keys, not from a second join of all regions
    keys = boundaries.select(_region_key(boundaries, name_col).alias("subzone")).distinct()
    global_max = counts.join(keys, "subzone", "left_semi").select(
        F.greatest(F.lit(1).cast("bigint"), F.coalesce(F.max("venue_count"), F.lit(0)).cast("bigint"))).scalar()
    return long.withColumn("global_max", global_max)


def hover_text(df: DataFrame, name_col: str = "region_name", count_col: str = "venue_count") -> DataFrame:
    """``name + ': ' + str(count)`` label (SCL5)."""
    return df.withColumn("hover_text", F.concat(F.col(name_col), F.lit(": "), F.col(count_col).cast("string")))


def bounding_box(df: DataFrame, xmin="min_x", ymin="min_y", xmax="max_x", ymax="max_y") -> DataFrame:
    """``total_bounds``: one row (minx, miny, maxx, maxy) over all regions;
    NULL geometry rows are skipped by the aggregate."""
    return df.agg(F.min(xmin).alias("minx"), F.min(ymin).alias("miny"),
                  F.max(xmax).alias("maxx"), F.max(ymax).alias("maxy"))


#: Flattening of the WGS 84 and GRS 80 ellipsoids (axis 6378137 m).
WGS84_F, GRS80_F = 1 / 298.257223563, 1 / 298.257222101
#: Scale and offsets of the 6-degree transverse Mercator grids.
GRID_SCALE, FALSE_EASTING, FALSE_NORTHING = 0.9996, 500_000.0, 10_000_000.0

# Krueger's series in the third flattening n, rows by harmonic,
# from the power of the harmonic up to n^4 (under 0.1 mm within a zone).
_TO_SPHERE = ((1 / 2, -2 / 3, 37 / 96, -1 / 360), (1 / 48, 1 / 15, -437 / 1440), (17 / 480, -37 / 840), (4397 / 161280,))
_TO_LATITUDE = ((2, -2 / 3, -2, 116 / 45), (7 / 3, -8 / 5, -227 / 45), (56 / 15, -136 / 35), (4279 / 630,))


def _harmonics(table, n: Column) -> list[Column]:
    return [sum((F.lit(float(c)) * F.pow(n, F.lit(float(i + j + 1))) for j, c in enumerate(row)), F.lit(0.0)) for i, row in enumerate(table)]


def _let(value: Column, body) -> Column:
    """body(value), the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def inverse_transverse_mercator(x: Column, y: Column, flattening: Column, meridian: Column, northing: Column) -> Column:
    """struct(lon, lat) in degrees of grid coordinates in metres, by Krueger's
    series; ellipsoid, central meridian (degrees) and false northing are
    columns, so rows of several zones go through one expression."""
    def on(p: Column) -> Column:
        n = p["n"]
        to_sphere = _harmonics(_TO_SPHERE, n)
        radius = F.lit(6378137.0) / (1 + n) * (1 + F.pow(n, F.lit(2.0)) / 4 + F.pow(n, F.lit(4.0)) / 64) * GRID_SCALE
        return _let(F.struct(((p["y"] - p["northing"]) / radius).alias("xi"), ((p["x"] - FALSE_EASTING) / radius).alias("eta")), lambda g: _let(F.struct(
            (g["xi"] - sum(c * F.sin(2 * k * g["xi"]) * F.cosh(2 * k * g["eta"]) for k, c in enumerate(to_sphere, 1))).alias("xi"),
            (g["eta"] - sum(c * F.cos(2 * k * g["xi"]) * F.sinh(2 * k * g["eta"]) for k, c in enumerate(to_sphere, 1))).alias("eta")),
            lambda s: _let(F.asin(F.sin(s["xi"]) / F.cosh(s["eta"])), lambda chi: F.struct(
                (p["meridian"] + F.degrees(F.atan2(F.sinh(s["eta"]), F.cos(s["xi"])))).alias("lon"),
                F.degrees(chi + sum(c * F.sin(2 * k * chi) for k, c in enumerate(_harmonics(_TO_LATITUDE, n), 1))).alias("lat")))))

    return _let(F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"), (flattening / (2 - flattening)).alias("n"), meridian.alias("meridian"), northing.alias("northing")), on)


def to_wgs84(x: Column, y: Column, srid: Column) -> tuple[Column, Column]:
    """Reproject (x, y) to EPSG:4326 longitude/latitude: identity for 4326 or
    unknown (NULL) SRID, closed-form inverse spherical Mercator for 3857, and
    inverse transverse Mercator for UTM (326zz north, 327zz south) and the
    Australian map grid on either datum (283zz, 78zz), whose geographic
    systems are taken as WGS 84 (they differ by under two metres).  Any other
    code fails the job."""
    zone = F.when(srid.between(32601, 32660), srid - 32600).when(srid.between(32701, 32760), srid - 32700).when(srid.between(28348, 28358), srid - 28300).when(srid.between(7846, 7859), srid - 7800)
    flattening = F.when(srid.between(32601, 32760), F.lit(WGS84_F)).otherwise(F.lit(GRS80_F))
    grid = inverse_transverse_mercator(x, y, flattening, zone * 6.0 - 183.0, F.when(srid.between(32601, 32660), 0.0).otherwise(FALSE_NORTHING))
    same, mercator = srid.isNull() | (srid == 4326), srid == 3857
    unknown = F.raise_error(F.concat(F.lit("unsupported CRS EPSG:"), srid.cast("string")))
    lon = F.when(same, x).when(mercator, F.degrees(x / F.lit(EARTH_RADIUS_M))).when(zone.isNotNull(), grid["lon"]).otherwise(unknown)
    lat = (F.when(same, y).when(mercator, F.degrees(F.lit(2.0) * F.atan(F.exp(y / F.lit(EARTH_RADIUS_M))) - F.lit(math.pi / 2)))
            .when(zone.isNotNull(), grid["lat"]).otherwise(unknown))
    return lon.cast("double"), lat.cast("double")


def reproject_boxes(df: DataFrame, srid_col: str | None = None, srid: int | None = 4326) -> DataFrame:
    """GEO1 on box boundaries: min/max x/y to WGS84 (monotone per axis)."""
    s = F.col(srid_col) if srid_col else F.lit(srid)
    lo_x, lo_y = to_wgs84(F.col("min_x"), F.col("min_y"), s)
    hi_x, hi_y = to_wgs84(F.col("max_x"), F.col("max_y"), s)
    return df.withColumns({"min_x": lo_x, "min_y": lo_y, "max_x": hi_x, "max_y": hi_y})
