"""Train/test splits that do not depend on partitioning (ML1-ML3).

``randomSplit`` draws per partition, so its membership changes with the
partition layout (and a retried task on another layout); these splits
hash a stable key instead.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forkcast.operators.ranks import with_position
from forkcast.session import materialize


def hash_split(df: DataFrame, key: str = "id", test_fraction: float = 0.2, seed: int = 42,
               buckets: int = 1000, exact: bool = False, hash_col=None) -> DataFrame:
    """Adds ``is_test``: pmod(xxhash64(key, seed), buckets) < fraction * buckets
    (one projection, sizes approximate).  ``hash_col`` replaces the hash.  ``exact=True`` puts exactly
    ceil(fraction * n) rows in the test side, as ``train_test_split`` does:
    the rows with the smallest hashes."""
    if exact:
        marked = stratified_split(df.withColumn("_one", F.lit(1)), "_one", key, test_fraction, seed,
                                  hash_col=hash_col, size_rule="ceil")
        return marked.drop("_one")
    h = F.pmod(hash_col if hash_col is not None else F.xxhash64(F.col(key), F.lit(seed)), F.lit(buckets))
    return df.withColumn("is_test", h < F.lit(int(round(test_fraction * buckets))))


def stratified_split(df: DataFrame, label: str, key: str = "id", test_fraction: float = 0.2,
                     seed: int = 42, hash_col=None, size_rule: str = "round") -> DataFrame:
    """Adds ``is_test`` with round(fraction * n_y) rows of every class y
    (``size_rule="ceil"``: ceil):
    the rows with the smallest xxhash64(key, seed) in that class.

    Classes are rows of a table, however many there are.  Each has a bracket
    of hashes in which its cut-off should lie; exact counts confirm it or
    widen it to the whole class.  Only rows within brackets are sorted, by
    ranges over all classes, so a class that holds most rows is in no one
    task; the cut-offs are joined back.  ``key`` must be unique: rows whose
    hashes meet as doubles go by key, so sizes stay exact.  Rows without a
    label are not in the test side.  ``hash_col`` replaces the hash; a hash
    that is not spread evenly costs a second round, nothing else."""
    h = (hash_col if hash_col is not None else F.xxhash64(F.col(key), F.lit(seed))).cast("double")
    base = df.withColumn("_h", h)
    places = base.select(F.col(label).alias("_y"), "_h", F.col(key).alias("_k")).where("_y is not null")
    wanted = F.lit(test_fraction) * F.col("n")
    wanted = F.ceil(wanted - 1e-9) if size_rule == "ceil" else F.rint(wanted).cast("long")
    sizes = places.groupBy("_y").agg(F.count("*").alias("n"), F.min("_h").alias("low"), F.max("_h").alias("high"))
    sizes = materialize(sizes.withColumn("need", F.greatest(F.least(wanted, F.col("n")), F.lit(0).cast("long"))), "classes")
    # hashes spread evenly, so a cut-off lies six standard errors around its share at most
    off = 6 * math.sqrt(max(test_fraction * (1 - test_fraction), 0.0)) / F.sqrt("n") + 2 / F.col("n")
    span = F.col("high") - F.col("low")
    brackets = sizes.where("need > 0 and need < n").select("_y", "need", "low", "high", (F.col("low") + span * (test_fraction - off)).alias("lo"),
                                                          (F.col("low") + span * (test_fraction + off)).alias("hi"))
    while True:
        below, inside = F.count_if(F.col("_h") < F.col("lo")), F.count_if(F.col("_h").between(F.col("lo"), F.col("hi")))
        counts = places.join(brackets.select("_y", "lo", "hi"), "_y").groupBy("_y").agg(below.alias("below"), inside.alias("inside"))
        counted = materialize(brackets.join(counts, "_y").withColumn("found", (F.col("below") < F.col("need")) & (F.col("need") <= F.col("below") + F.col("inside"))), "brackets")
        if counted.where("not found").isEmpty():
            break
        widened = {c: F.when(F.col("found"), F.col(c)).otherwise(F.col(end)).alias(c) for c, end in (("lo", "low"), ("hi", "high"))}
        brackets = counted.select("_y", "need", "low", "high", widened["lo"], widened["hi"])
    inside = places.join(counted.select("_y", "lo", "hi", (F.col("need") - F.col("below")).alias("rank")), "_y").where("_h between lo and hi")
    last = with_position(inside.select("_y", "_h", "_k", "rank"), ["_y"], [F.col("_h"), F.col("_k")]).where("position = rank - 1")
    cuts = last.select("_y", F.col("_h").alias("_cut"), F.col("_k").alias("_cut_key"))
    every = sizes.where("need = n").select("_y", F.lit(float("inf")).alias("_cut"), F.lit(None).cast(df.schema[key].dataType).alias("_cut_key"))
    cuts = materialize(cuts.unionAll(every), "cuts")
    is_test = (F.col("_h") < F.col("_cut")) | ((F.col("_h") == F.col("_cut")) & (F.col(key) <= F.col("_cut_key")))
    marked = base.join(cuts, F.col(label) == F.col("_y"), "left")
    return marked.select(*[F.col(f"`{c}`") for c in df.columns], F.coalesce(is_test, F.lit(False)).alias("is_test"))
