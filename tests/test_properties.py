"""Properties from the blueprint's test strategy, on the driver tables."""

from functools import reduce

from pyspark.sql import functions as F

from forkcast.functions.scalars import rating_binary
from forkcast.operators import evaluate, explore, features, geo
from forkcast.sources.tables import boundaries_view, venue_view

SF = "/root/testdata/sf0.01"


def test_multi_hot_row_sum_is_distinct_items(spark):
    v = venue_view(spark, SF).select("id", "cuisine")
    mh = features.diversity(features.multi_hot(v, "cuisine"), "cuisine")
    cols = [c for c in mh.columns if c.startswith("cuisine_") and c != "cuisine_diversity"]
    total = reduce(lambda a, b: a + b, [F.col(c) for c in cols])
    assert mh.where(total != F.col("cuisine_diversity")).count() == 0


def test_histogram_bins_sum_to_non_null_count(spark):
    v = venue_view(spark, SF)
    h = explore.histogram(v, "cost", 30)
    assert h.agg(F.sum("n")).first()[0] == v.where("cost IS NOT NULL").count()
    hg = explore.histogram_by_group(v, "cost", "rating_text", 20)
    assert hg.agg(F.sum("n")).first()[0] == v.where("cost IS NOT NULL AND rating_text IS NOT NULL").count()


def test_confusion_cells_sum_to_scored_rows(spark):
    v = venue_view(spark, SF).select(rating_binary("rating_text").alias("y"),
                                     (F.col("votes") > 500).cast("int").alias("p")).dropna()
    cells = evaluate.confusion_matrix(v, "y", "p")
    assert cells.count() == 4 and cells.agg(F.sum("n")).first()[0] == v.count()


def test_left_join_keeps_every_boundary_row(spark):
    b = boundaries_view(spark, SF)
    out = geo.cuisine_counts(venue_view(spark, SF), b, "Gear")
    assert out.count() == b.count() and out.where("venue_count IS NULL").count() == 0
