"""k-NN imputation against a direct numpy implementation of the rules."""

import math

import numpy as np
import pytest

from forkcast.operators.knn import kd_leaves, knn_impute, search

COLS = ["t1", "t2", "p1", "p2", "p3"]


def brute(rows, k=5):
    ids = [r[0] for r in rows]
    X = np.array([[np.nan if v is None else v for v in r[1:]] for r in rows], dtype=float)
    D = X.shape[1]
    out = X.copy()
    for t in (0, 1):
        donors = [j for j in range(len(rows)) if not np.isnan(X[j, t])]
        if not donors:
            continue
        mean = np.mean(X[donors, t])
        for i in range(len(rows)):
            if not np.isnan(X[i, t]):
                continue
            cand = []
            for j in donors:
                both = ~np.isnan(X[i]) & ~np.isnan(X[j])
                m = both.sum()
                d = math.sqrt(D / m * np.sum((X[i, both] - X[j, both]) ** 2)) if m else math.inf
                cand.append((d, ids[j], X[j, t]))
            cand.sort()
            best = cand[:k]
            fin = [c for c in best if c[0] != math.inf]
            if not fin:
                out[i, t] = mean
            elif any(c[0] == 0 for c in fin):
                out[i, t] = np.mean([c[2] for c in fin if c[0] == 0])
            else:
                out[i, t] = sum(c[2] / c[0] for c in fin) / sum(1 / c[0] for c in fin)
    return {ids[i]: (out[i, 0], out[i, 1]) for i in range(len(rows))}


def run(spark, rows, **how):
    df = spark.createDataFrame(rows, "id long, t1 double, t2 double, p1 double, p2 double, p3 double")
    res = knn_impute(df, targets=("t1", "t2"), predictors=("p1", "p2", "p3"), k=5, **how)
    return {r["id"]: (r["t1"], r["t2"]) for r in res.collect()}


def close(a, b):
    if a is None or (isinstance(a, float) and math.isnan(a)):
        return b is None or (isinstance(b, float) and math.isnan(b))
    return b is not None and abs(a - b) < 1e-9


@pytest.mark.parametrize("seed", [0, 1])
def test_random_with_gaps(spark, seed):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(120):
        vals = [float(rng.integers(0, 50)) for _ in COLS]
        for j in range(len(vals)):
            if rng.random() < (0.3 if j < 2 else 0.1):
                vals[j] = None
        rows.append((i, *vals))
    got, want = run(spark, rows), brute(rows)
    for i in want:
        assert close(want[i][0], got[i][0]) and close(want[i][1], got[i][1]), (i, want[i], got[i])


def test_edge_cases(spark):
    rows = [
        (1, None, 1.0, 1.0, 2.0, 3.0),     # exact duplicate of 2 on predictors -> d = 0
        (2, 4.0, 1.0, 1.0, 2.0, 3.0),
        (3, 2.0, 1.0, 1.0, 2.0, 3.0),      # second d = 0 donor
        (4, None, None, None, None, None),  # no shared column -> donor mean
        (5, 3.0, 2.0, 10.0, 10.0, 10.0),
        (6, None, 5.0, 10.0, 10.0, 12.0),   # equal distances to 5 and 7
        (7, 1.0, 5.0, 10.0, 10.0, 14.0),
    ]
    got, want = run(spark, rows), brute(rows)
    for i in want:
        assert close(want[i][0], got[i][0]) and close(want[i][1], got[i][1]), (i, want[i], got[i])
    assert got[1][0] == 3.0          # mean of the two d = 0 donors
    assert got[4][0] == pytest.approx(np.mean([4.0, 2.0, 3.0, 1.0]))


def test_present_cells_unchanged_and_all_null_target(spark):
    rows = [(i, None, float(i), float(i % 3), 1.0, 2.0) for i in range(10)]
    got = run(spark, rows)
    assert all(got[i][0] is None for i in got)       # nothing to learn from
    assert all(got[i][1] == float(i) for i in got)


def test_dense_cluster_starts_finer(spark):
    """A third-plus of the rows crowd one tiny region: still exact."""
    rng = np.random.default_rng(7)
    rows = []
    for i in range(300):                                    # dense cluster of distinct points
        vals = [float(rng.integers(0, 5)), float(rng.integers(0, 9)),
                float(rng.random()), float(rng.random()), float(rng.random())]
        if i % 3 == 0:
            vals[0] = None
        rows.append((i, *vals))
    for i in range(300, 360):                               # sparse background
        vals = [float(rng.integers(0, 5)), float(rng.integers(0, 9)),
                float(rng.integers(0, 1000)), float(rng.integers(0, 1000)), float(rng.integers(0, 1000))]
        if i % 4 == 0:
            vals[0] = None
        rows.append((i, *vals))
    got, want = run(spark, rows), brute(rows)
    for i in want:
        assert close(want[i][0], got[i][0]) and close(want[i][1], got[i][1]), (i, want[i], got[i])


def nearest(receivers, donors, ids, k):
    dist = np.sqrt(((receivers[:, None, :] - donors[None, :, :]) ** 2).sum(2))
    order = np.lexsort((np.broadcast_to(ids, dist.shape), dist), axis=1)[:, :k]
    return np.take_along_axis(dist, order, 1), ids[order]


def three_scales(rng, n):
    """A cluster in a cluster in a cloud, each 10,000 times denser a side."""
    return np.concatenate([rng.normal(0, 1, (n, 4)), 0.3 + rng.normal(0, 1e-4, (n, 4)), 0.3 + rng.normal(0, 1e-8, (n, 4))])


def test_pairs_stay_few_at_three_scales():
    rng = np.random.default_rng(3)
    donors, receivers = three_scales(rng, 4000), three_scales(rng, 300)
    ids = rng.permutation(len(donors))
    dist, place, pairs = search(receivers, donors, ids, 5)
    want, who = nearest(receivers, donors, ids, 5)
    assert np.allclose(dist, want, rtol=1e-12) and (ids[place] == who).all()
    assert pairs <= 24 * 64 * len(receivers)          # all pairs: 12,000 a receiver


def test_pairs_stay_few_beyond_all_data():
    rng = np.random.default_rng(4)
    donors = rng.normal(0, 1, (12_000, 4))
    receivers = rng.normal(0, 1, (1000, 4)) * rng.choice([1e2, 1e4, 1e6], (1000, 1)) + 50
    ids = np.arange(len(donors))
    dist, place, pairs = search(receivers, donors, ids, 5)
    want, who = nearest(receivers, donors, ids, 5)
    assert np.allclose(dist, want, rtol=1e-12) and (ids[place] == who).all()
    assert pairs <= 24 * 64 * len(receivers)


def test_ties_bounds_and_small_sides():
    donors = np.array([[0.0], [0.0], [2.0], [2.0], [9.0]])
    dist, place, _ = search(np.array([[1.0], [9.0]]), donors, np.array([5, 4, 3, 2, 1]), 3, bound=np.array([np.inf, 0.0]))
    assert place.tolist() == [[3, 2, 1], [4, -1, -1]] or place.tolist()[0] == [3, 2, 1] and place[1, 0] == 4
    assert dist[0].tolist() == [1.0, 1.0, 1.0]
    few, who, _ = search(np.zeros((1, 1)), donors, np.array([5, 4, 3, 2, 1]), 4, leaf=2)          # leaves hold fewer than k
    assert sorted(who[0].tolist()) == [0, 1, 2, 3] and few[0].tolist() == [0.0, 0.0, 2.0, 2.0]
    assert search(np.zeros((0, 2)), np.zeros((3, 2)), np.arange(3), 2)[2] == 0
    assert (search(np.zeros((2, 2)), np.zeros((0, 2)), np.arange(0), 2)[1] == -1).all()
    order, starts = kd_leaves(np.zeros((500, 3)), 64)
    assert sorted(order) == list(range(500)) and starts.tolist() == [0, 500]


@pytest.mark.parametrize("block", [40, 7])
def test_many_blocks_and_pieces(spark, block):
    rng = np.random.default_rng(block)
    rows = []
    for i in range(500):
        at = rng.choice([0, 1, 2])
        vals = [float(rng.integers(0, 9)), float(rng.integers(0, 4)), *(float(x) for x in three_scales(rng, 1)[at][:3])]
        vals[0] = None if rng.random() < 0.4 else vals[0]
        vals[1] = None if rng.random() < 0.2 else vals[1]
        rows.append((i, *vals))
    rows += [(500 + i, None if i % 2 else 3.0, 1.0, 0.25, 0.25, 0.25) for i in range(60)]      # one crowded point
    rows += [(600 + i, None, None, 1e5 * (i + 1), -1e5, 0.0) for i in range(20)]                 # beyond all data
    got, want = run(spark, rows, block=block, leaf=8), brute(rows)
    for i in want:
        assert close(want[i][0], got[i][0]) and close(want[i][1], got[i][1]), (i, want[i], got[i])


def test_text_ids(spark):
    df = spark.createDataFrame([("a", None, 1.0), ("b", 2.0, 1.0), ("c", 4.0, 1.5), ("d", 8.0, 9.0)], "id string, t double, p double")
    got = {r["id"]: r["t"] for r in knn_impute(df, targets=("t",), predictors=("p",), k=1).collect()}
    assert got == {"a": 2.0, "b": 2.0, "c": 4.0, "d": 8.0}


def test_only_donors_that_may_be_nearest_are_sorted(monkeypatch):
    rng = np.random.default_rng(6)
    donors, receivers, ids = rng.integers(0, 60, (3000, 3)).astype(float), rng.integers(0, 60, (400, 3)).astype(float), rng.permutation(3000)
    sorted_, plain = [], np.lexsort
    monkeypatch.setattr(np, "lexsort", lambda keys, axis=-1: sorted_.append(np.size(keys[0])) or plain(keys, axis=axis))
    dist, place, pairs = search(receivers, donors, ids, 5)
    assert sum(sorted_) < 0.7 * pairs
    every = np.sqrt(((receivers[:, None] - donors[None]) ** 2).sum(2))
    for r in range(400):
        want = plain((ids, every[r]))[:5]
        assert place[r].tolist() == want.tolist() and np.allclose(dist[r], every[r][want])
