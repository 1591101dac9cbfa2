"""Places of rows in an order, with no group and no order in one task.

A window over a group (or over everything) sorts that group in one task.
Here the rows are dealt by ranges of (group, order), sorted within each task
and written once; counts per (group, task) give every task its offset.  What
is summed up in order is one row per group and task, never the group's rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forkcast.session import materialize

_AT = (1 << 33) - 1


def with_position(df: DataFrame, by: list[str], order: list[Column], name: str = "position") -> DataFrame:
    """``df`` with the place (from 0, long) of each row in its group.

    ``by`` may be empty: then all rows are one group.  Null group values form
    a group of their own; ``order`` sorts as Spark sorts (say where nulls go
    in the expressions).  Equal rows get places in any order; they too are
    spread over tasks.  Column names of ``df`` starting with ``_rank_`` are
    taken.  An empty table gives an empty one.
    """
    keys = [F.col(f"`{c}`") for c in by]
    tied = df.withColumn("_rank_tie", F.monotonically_increasing_id())
    dealt = tied.repartitionByRange(*keys, *order, "_rank_tie").sortWithinPartitions(*keys, *order, "_rank_tie").drop("_rank_tie")
    rows = materialize(dealt.withColumn("_rank_task", F.spark_partition_id()).withColumn("_rank_at", F.monotonically_increasing_id().bitwiseAND(F.lit(_AT))), "ranked")
    parts = rows.groupBy(*keys, "_rank_task").agg(F.min("_rank_at").alias("_rank_first"), F.count("*").alias("_rank_n"))
    # one row a group and task; with no groups one row a task, which one task sums up
    before = Window.partitionBy(*keys).orderBy("_rank_task").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_rank_before", F.coalesce(F.sum("_rank_n").over(before), F.lit(0)))
    parts = parts.select(*[F.col(f"`{c}`").alias(f"_rank_by{i}") for i, c in enumerate(by)], F.col("_rank_task").alias("_rank_of"),
                         (F.col("_rank_before") - F.col("_rank_first")).alias("_rank_shift"))
    same = [F.col(f"`{c}`").eqNullSafe(F.col(f"_rank_by{i}")) for i, c in enumerate(by)] + [F.col("_rank_task") == F.col("_rank_of")]
    joined = rows.join(parts if by else F.broadcast(parts), same)
    return joined.withColumn(name, F.col("_rank_at") + F.col("_rank_shift")).select(*[F.col(f"`{c}`") for c in df.columns], name)
