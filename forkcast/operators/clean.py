"""Cleaning: median / mode fills, spatial drop, rating bands, filters
(IMP1, IMP3-IMP6, FLT1-FLT8, PRJ2-PRJ5).

Fills are masked updates (``coalesce``): a present cell never changes.
Fitted values (median, mode) are scalars: the median from the bounded
exact-quantile routine, the mode from a grouped count ordered by
(count desc, value asc) and read as a scalar subquery, so no row data
reaches the driver and no one-row cross join is planned.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forkcast.functions.scalars import rating_band
from forkcast.functions.text import casefold, col_, nan_to_null
from forkcast.operators.stats import exact_quantiles


def present(df: DataFrame, cols) -> list[str]:
    """Presence guard (PRJ2): the listed columns that exist, in list order."""
    return [c for c in cols if c in df.columns]


def median_fill(df: DataFrame, cols=("cost", "cost_2")) -> DataFrame:
    """Fill missing cells with the column's exact median (IMP1)."""
    cols = present(df, cols)
    if not cols:
        return df
    med = exact_quantiles(df, cols, [0.5])
    return df.withColumns({c: F.coalesce(nan_to_null(F.col(c)), F.lit(med[c][0]).cast("double"))
                           for c in cols})


def mode_value(df: DataFrame, col: str) -> Column:
    """Most frequent non-null value, lowest value on ties; NULL if none.
    A scalar subquery over a partially aggregated grouped count."""
    return (df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
              .orderBy(F.desc("_n"), F.asc(col)).limit(1).select(col).scalar())


def mode_fill(df: DataFrame, col: str = "type") -> DataFrame:
    """Fill missing cells with the mode (IMP3); no-op if all missing."""
    if col not in df.columns:
        return df
    return df.withColumn(col, F.coalesce(F.col(col), mode_value(df, col)))


def drop_missing(df: DataFrame, cols=("lat", "lng")) -> DataFrame:
    """Drop rows missing any of the present columns (IMP4, FLT4)."""
    cols = present(df, cols)
    if not cols:
        return df
    return df.where(reduce(lambda a, b: a & b, [nan_to_null(F.col(c)).isNotNull() for c in cols]))


def rating_band_fill(df: DataFrame, overwrite: bool = False,
                     text_col: str = "rating_text", number_col: str = "rating_number") -> DataFrame:
    """Rating label from the number: fill only missing labels (IMP5), or
    overwrite every row (IMP6, ``overwrite=True``)."""
    if text_col not in df.columns or number_col not in df.columns:
        return df
    band = rating_band(nan_to_null(F.col(number_col)))
    return df.withColumn(text_col, band if overwrite else F.coalesce(F.col(text_col), band))


# -- filters and projections ------------------------------------------------

def where_in(df: DataFrame, col: str, values: list) -> DataFrame:
    return df.where(F.col(col).isin(values))


def where_equals(df: DataFrame, col: str, value) -> DataFrame:
    return df.where(F.col(col) == F.lit(value))


def where_casefold_equals(df: DataFrame, col: str, value: str) -> DataFrame:
    return df.where(casefold(col) == casefold(F.lit(value)))


def drop_any_null(df: DataFrame) -> DataFrame:
    return df.dropna("any")


def any_starts_with(df: DataFrame, col: str, prefix: str = "[") -> Column:
    """FLT7 as a scalar subquery: does any row's text start with prefix?"""
    return df.select(F.coalesce(F.bool_or(col_(col).startswith(prefix)), F.lit(False))).scalar()


def has_min_rows(df: DataFrame, n: int = 5) -> bool:
    """FLT8 without a full count: reads at most n rows."""
    return df.limit(n).count() >= n


def columns_with_prefix(df: DataFrame, prefix: str) -> list[str]:
    """Prefix column selection (PRJ6), in schema order."""
    return [c for c in df.columns if c.startswith(prefix)]


def drop_columns(df: DataFrame, cols) -> DataFrame:
    """Missing names are ignored (PRJ4)."""
    return df.drop(*present(df, cols))


def with_null_column(df: DataFrame, name: str, dtype: str = "int") -> DataFrame:
    return df.withColumn(name, F.lit(None).cast(dtype))
