"""Dictionaries of category values as tables (ARR3, FE2, FE3, FE5).

Values get codes 0, 1, 2, ... in their own order: distinct values are dealt by
ranges, sorted within tasks and counted, and every task starts where the ones
before it end.  Rows are encoded by a join, so a dictionary may be larger than
any one machine: the driver sees its size and nothing else of it.
"""

from __future__ import annotations

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forkcast.operators.ranks import with_position
from forkcast.session import materialize


def codes(df: DataFrame, value: Column) -> DataFrame:
    """(value, code): the distinct values in order, codes from 0 (long).
    Nulls have no code; no values give no rows."""
    distinct = df.select(value.alias("value")).where("value is not null").distinct()
    return materialize(with_position(distinct, [], [F.col("value")], "code"), "codes")


def size(dictionary: DataFrame) -> int:
    return dictionary.count()


def encode(df: DataFrame, value: Column, dictionary: DataFrame, out: str) -> DataFrame:
    """``df`` with ``out``: the code of ``value``, null for nulls and values
    that the dictionary lacks.  Rows of a frequent value are not gathered:
    they are joined to one row, and AQE splits or broadcasts as sizes say."""
    known = dictionary.select(F.col("value").alias("_code_value"), F.col("code").alias(out))
    return df.drop(out).join(known, value == F.col("_code_value"), "left").drop("_code_value")


def encode_items(df: DataFrame, items: Column, dictionary: DataFrame, out: str) -> DataFrame:
    """``df`` with ``out``, array<bigint>: the distinct codes of an array's
    items in order; unknown and null items have none, a null array gives an
    empty one.  Repeated rows stay repeated."""
    rows = materialize(df.drop(out).withColumn("_code_row", F.monotonically_increasing_id()).withColumn("_code_items", items), "items")
    pairs = rows.select("_code_row", F.explode(F.array_distinct("_code_items")).alias("_code_value"))
    found = pairs.join(dictionary.select(F.col("value").alias("_code_value"), "code"), "_code_value")
    lists = found.groupBy("_code_row").agg(F.sort_array(F.collect_list("code")).alias(out))
    return rows.join(lists, "_code_row", "left").withColumn(out, F.coalesce(out, F.array().cast("array<bigint>"))).drop("_code_row", "_code_items")


def sparse_vectors(df: DataFrame, indices: Column, length: int, out: str) -> DataFrame:
    """``df`` with ``out``, a sparse 0/1 vector of ``length`` with ones at the
    (ordered, distinct) ``indices``.

    The vector's fields are built by SQL functions and written; the table is
    read back under the vector type, which is those fields by another name.
    """
    at = indices.cast("array<int>")
    fields = F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(length).alias("size"), at.alias("indices"), F.transform(at, lambda _: F.lit(1.0)).alias("values"))
    plain = df.drop(out)
    schema = T.StructType([*plain.schema.fields, T.StructField(out, VectorUDT())])
    return materialize(plain.withColumn(out, fields), "vectors", schema)
