"""Per-sample descent against a plain Python pass."""

import numpy as np
import pytest

from forkcast.operators import descent, models

COLS = ["x1", "x2", "x3"]


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(600, 3)) * [1, 5, 0.2] + [0, 3, -1]
    y = x @ [2.0, -0.5, 4.0] + 7 + 0.01 * rng.normal(size=600)
    return spark.createDataFrame([(i, *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y))], "id long, x1 double, x2 double, x3 double, y double")


def test_one_shard_is_a_plain_pass(spark, table):
    mean, scale = np.array([0.0, 3.0, -1.0]), np.array([1.0, 5.0, 0.2])
    rows = descent.dealt(table, COLS, "y", "id", mean, scale, 1, 42).persist()
    got = descent._round(rows, np.array([0.1, 0.0, -0.2]), 0.5, 1e-3, 1e-2, 2)
    ordered = rows.collect()
    assert [r._order for r in ordered] == sorted(r._order for r in ordered) and len(ordered) == 600
    w, b, sums, steps = [0.1, 0.0, -0.2], 0.5, [0.0] * 4, 0
    for _ in range(2):
        for r in ordered:
            off = 1e-3 * (sum(a * c for a, c in zip(w, r._x)) + b - r._y)
            w = [a * (1 - 1e-3 * 1e-2) - off * c for a, c in zip(w, r._x)]
            b -= off
            sums = [s + v for s, v in zip(sums, [*w, b])]
            steps += 1
    assert got[0] == 600 and np.allclose(got[1:] / 600, [*w, b, *(s / steps for s in sums)], rtol=1e-10)
    rows.unpersist()


def test_layout_changes_nothing(table):
    train, valid = models.split(table, "hash", "id", test_fraction=0.1)
    fits = [descent.fit(train.repartition(k), valid, COLS, "y", rate=1e-3, epochs=20, local_epochs=5, shards=3) for k in (1, 9)]
    assert np.allclose(fits[0].w, fits[1].w, rtol=1e-9) and fits[0].b == pytest.approx(fits[1].b, rel=1e-9)


def test_converges_to_the_line_and_stops(table):
    train, valid = models.split(table, "hash", "id", test_fraction=0.1)
    fitted = descent.fit(train, valid, COLS, "y", rate=1e-2, epochs=3000, local_epochs=20, shards=4, least_gain=1e-6)
    assert np.allclose(fitted.w / fitted.scale, [2.0, -0.5, 4.0], atol=0.02)
    scored = valid.withColumn("prediction", fitted.prediction(COLS)).toPandas()
    assert ((scored["prediction"] - scored["y"]) ** 2).mean() < 0.01
    assert descent.fit(train.limit(0), valid, COLS, "y").w.tolist() == [0.0] * 3


def test_rounds_do_not_read_the_rows_again(spark, table):
    """A round's map equals plain passes, shard by shard; so do many rounds of it."""
    mean, scale = np.array([0.0, 3.0, -1.0]), np.array([1.0, 5.0, 0.2])
    rows = descent.dealt(table, COLS, "y", "id", mean, scale, 3, 42)
    total = descent._round_map(rows, 3, 1e-3, 1e-2, 7)
    shards = {}
    for r in rows.collect():
        shards.setdefault(r._shard, []).append((r._x, r._y))
    w, b = np.zeros(3), 0.0
    for _ in range(4):
        want = np.zeros(8)
        for part in shards.values():
            new_w, new_b, mean_w, mean_b = descent.epochs_of(np.array([x for x, _ in part]), np.array([y for _, y in part]), w, b, 1e-3, 1e-2, 7)
            want += len(part) * np.concatenate([new_w, [new_b], mean_w, [mean_b]])
        got = descent._applied(total, w, b)
        assert total[0] == 600 and len(shards) == 3 and np.allclose(got, want, rtol=1e-9)
        w, b = got[:3] / 600, got[3] / 600
