"""Splits are stable and exact; metrics follow the zero-division rules."""

from pyspark.sql import functions as F

from forkcast.operators.evaluate import classification_metrics, confusion_matrix
from forkcast.operators.split import hash_split, stratified_split


def test_hash_split_independent_of_partitioning(spark):
    df = spark.range(2000).withColumnRenamed("id", "id")
    a = {r.id for r in hash_split(df.repartition(3)).where("is_test").collect()}
    b = {r.id for r in hash_split(df.repartition(11)).where("is_test").collect()}
    assert a == b and 300 < len(a) < 500


def test_stratified_sizes(spark):
    df = spark.range(1000).withColumn("y", (F.col("id") % 10 < 3).cast("int"))
    out = stratified_split(df, "y")
    sizes = {r.y: r.n for r in out.where("is_test").groupBy("y").agg(F.count("*").alias("n")).collect()}
    assert sizes == {1: 60, 0: 140}


def test_never_predicts_positive(spark):
    df = spark.createDataFrame([(1, 0), (0, 0), (1, 0), (0, 0)], "y int, p int")
    m = classification_metrics(df, "y", "p").first()
    assert (m.tn, m.fp, m.fn, m.tp) == (2, 0, 2, 0)
    assert m.precision == 0.0 and m.recall == 0.0 and m.f1 == 0.0 and m.accuracy == 0.5
    cells = {(r.truth, r.predicted): r.n for r in confusion_matrix(df, "y", "p").collect()}
    assert cells == {(0, 0): 2, (0, 1): 0, (1, 0): 2, (1, 1): 0}


def test_stratified_exact_with_hash_ties(spark):
    """Distinct keys whose hashes collide (forced by a coarse hash) still
    give exact per-class sizes."""
    df = spark.range(600).select("id", (F.col("id") % 3 == 0).cast("int").alias("y"))
    out = stratified_split(df, "y", hash_col=F.col("id") % 7)
    sizes = {r.y: r.n for r in out.where("is_test").groupBy("y").agg(F.count("*").alias("n")).collect()}
    assert sizes == {1: 40, 0: 80}
    assert out.count() == 600 and out.select("id").distinct().count() == 600


def test_exact_hash_split_sizes(spark):
    for n in (10, 999, 1001):
        df = spark.range(n)
        out = hash_split(df, "id", 0.2, exact=True)
        assert out.where("is_test").count() == -(-n * 2 // 10)          # ceil(0.2 n)
        assert out.count() == n


def test_very_many_classes(spark):
    """100,000 classes of 1 to 7 rows, one of 20,000: exact sizes, no class on the driver."""
    small = spark.range(100_000).selectExpr("id as y", "explode(sequence(1, 1 + cast(id % 7 as int))) as i")
    df = small.selectExpr("y", "y * 10 + i as id").unionAll(spark.range(20_000).selectExpr("-1L as y", "-id - 1 as id"))
    out = stratified_split(df, "y", test_fraction=0.25)
    assert out.columns == ["y", "id", "is_test"]
    sizes = out.groupBy("y").agg(F.count("*").alias("n"), F.count_if("is_test").alias("k"))
    assert sizes.count() == 100_001
    assert sizes.where(F.col("k") != F.rint(0.25 * F.col("n"))).isEmpty()


def test_split_ends_and_missing_labels(spark):
    df = spark.createDataFrame([(i, "ab"[i % 2] if i < 30 else None) for i in range(40)], "id long, y string")
    for part, want in ((0.0, 0), (1.0, 30), (0.5, 14 + 2 * 0)):
        out = stratified_split(df, "y", test_fraction=part)
        chosen = out.where("is_test").count()
        assert chosen == (want if part != 0.5 else 2 * round(0.5 * 15)) and out.count() == 40
        assert out.where("y is null and is_test").isEmpty()
    assert stratified_split(df.limit(0), "y").collect() == []
    odd = stratified_split(spark.range(1000).selectExpr("id", "0 as y"), "y", test_fraction=0.1, hash_col=F.when(F.col("id") < 990, 5).otherwise(F.col("id")))
    assert {r.id for r in odd.where("is_test").collect()} == set(range(100))
