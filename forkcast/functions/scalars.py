"""Banding, label maps, flags and numeric coercion (SCL10-SCL16, IMP5-6, FE1, FE10)."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from forkcast.functions.text import col_

# Rating label order and the rating thresholds of the bands.
RATING_ORDER = ["Poor", "Average", "Good", "Very Good", "Excellent"]
RATING_BANDS = [(4.5, "Excellent"), (4.0, "Very Good"), (3.5, "Good"), (2.5, "Average")]
# Labels counted as a good rating (binary target).
RATING_BINARY = {"Poor": 0, "Average": 0, "Good": 1, "Very Good": 1, "Excellent": 1}
# EDA cost bins, left-closed [0,20) [20,50) [50,100) [100,200) [200,500).
EDA_COST_EDGES = [0, 20, 50, 100, 200, 500]
# Feature cost bins, right-closed with the lowest edge included.
FEATURE_COST_EDGES = [0, 50, 100, 200, 500]
FEATURE_COST_LABELS = ["Low", "Medium", "High", "Luxury"]


def rating_band(c) -> Column:
    """Rating number -> label (>=4.5 Excellent, >=4.0 Very Good, >=3.5 Good,
    >=2.5 Average, else Poor); NULL stays NULL."""
    x = col_(c)
    out = F.when(x.isNull(), F.lit(None).cast("string"))
    for edge, label in RATING_BANDS:
        out = out.when(x >= F.lit(edge), F.lit(label))
    return out.otherwise(F.lit("Poor"))


def map_values(c, mapping: dict, cast: str | None = None) -> Column:
    """Dictionary lookup (``Series.map(dict)``); unknown keys give NULL."""
    m = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    out = m[col_(c)]
    return out.cast(cast) if cast else out


def rating_ordinal(c) -> Column:
    """Poor=1 ... Excellent=5 (INT)."""
    return map_values(c, {k: i + 1 for i, k in enumerate(RATING_ORDER)}, "int")


def rating_binary(c) -> Column:
    """Good, Very Good, Excellent -> 1; Poor, Average -> 0 (INT)."""
    return map_values(c, RATING_BINARY, "int")


def bin_left_closed(c, edges=EDA_COST_EDGES) -> Column:
    """``pd.cut(right=False)``: label '[lo, hi)' for lo <= x < hi; outside
    (incl. the top edge itself) NULL.  Not ``Bucketizer``, which closes the
    last bin."""
    x = col_(c)
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for lo, hi in zip(edges[:-1], edges[1:]):
        out = out.when((x >= F.lit(lo)) & (x < F.lit(hi)), F.lit(f"[{lo}, {hi})"))
    return out


def bin_right_closed(c, edges=FEATURE_COST_EDGES, labels=FEATURE_COST_LABELS) -> Column:
    """``pd.cut(include_lowest=True)``: first bin [lo, hi], then (lo, hi];
    outside NULL (so > 500 is NULL)."""
    x = col_(c)
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for i, (lo, hi, lab) in enumerate(zip(edges[:-1], edges[1:], labels)):
        lower = (x >= F.lit(lo)) if i == 0 else (x > F.lit(lo))
        out = out.when(lower & (x <= F.lit(hi)), F.lit(lab))
    return out


def bin_index(c, edges, right: bool = False) -> Column:
    """0-based ordinal of the bin (for ordering bins); NULL outside."""
    x = col_(c)
    out = F.when(F.lit(False), F.lit(None).cast("int"))
    for i, (lo, hi) in enumerate(zip(edges[:-1], edges[1:])):
        if right:
            cond = ((x >= F.lit(lo)) if i == 0 else (x > F.lit(lo))) & (x <= F.lit(hi))
        else:
            cond = (x >= F.lit(lo)) & (x < F.lit(hi))
        out = out.when(cond, F.lit(i))
    return out


def flag_greater(c, threshold: Column) -> Column:
    """``(x > m).astype(int)``: a comparison with a missing value is 0."""
    return F.coalesce(col_(c) > threshold, F.lit(False)).cast("int")


def flag_at_least_keep_null(c, threshold: Column) -> Column:
    """``(x >= m).cast('int')`` in Spark: NULL stays NULL."""
    return (col_(c) >= threshold).cast("int")


def to_int_or_zero(c) -> Column:
    """``to_numeric(errors='coerce').fillna(0).astype(int)``."""
    return F.coalesce(F.col(c).try_cast("int") if isinstance(c, str) else c.try_cast("int"), F.lit(0))


def fmt_fixed(c, places: int = 4) -> Column:
    """``f'{x:.4f}'`` (no thousands separator)."""
    return F.format_string(f"%.{places}f", col_(c))


def fmt_percent(c, places: int = 2) -> Column:
    """``f'{x:.2f}%'``."""
    return F.concat(F.format_string(f"%.{places}f", col_(c)), F.lit("%"))
