import itertools
import random
import re

import numpy as np
import pytest

from brute import lower
from forkcast.llm import decontam
from forkcast.llm.decontam import PERCENT, STRETCH, allowed, masks_for


@pytest.mark.parametrize("words", range(decontam.SHORTEST, 14))
def test_no_allowed_substitution_hides_a_stretch(words):
    for changed in itertools.combinations(range(words), allowed(words)):
        same = ["0" if i in changed else "1" for i in range(words)]
        assert any(all(same[p + i] == "1" for i, bit in enumerate(m) if bit == "1")
                   for m in masks_for(words) for p in range(words - len(m) + 1)), changed


def word_list(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower(text))


def brute(text, item):
    """Every alignment of every stretch, one array of equal words at a time."""
    a, b = word_list(text), word_list(item)
    need = min(STRETCH, len(b))
    if len(b) < decontam.SHORTEST or len(a) < need:
        return False
    number = {w: i for i, w in enumerate(b)}
    a, b = (np.array([number.get(w, -1) for w in x]) for x in (a, b))
    same = a[:, None] == b[None, :]
    n, m = len(a) - need + 1, len(b) - need + 1
    equal = sum(same[k:k + n, k:k + m].astype(np.int16) for k in range(need))
    return bool((100 * equal >= need * PERCENT).any())


@pytest.mark.parametrize("most", [10**6, 0])
def test_against_all_alignments(spark, most):
    rng = random.Random(3)
    word = lambda: rng.choice(["the", "of", "und", "été", "Zug", *(f"w{i}" for i in range(60))])
    items = [[word() for _ in range(n)] for n in (2, 4, 5, 6, 7, 8, 10, 12, 13, 20, 40)]
    docs = []
    for _ in range(150):
        part = list(rng.choice(items))[rng.choice([0, 0, 1]):]
        for _ in range(rng.choice([0, 1, 2, 3, 6])):
            part[rng.randrange(len(part))] = word()
        docs.append(", ".join([*(word() for _ in range(rng.choice([0, 9, 50]))), *part, *(word() for _ in range(9))]))
    docs += ["", None, "x " * 50_000 + " ".join(items[-1])]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(docs)], "doc_id long, text string, item_id long")
    test = [(i, " ".join(x).upper(), "z") for i, x in enumerate(items)] + [(50, None, ""), (51, "", "")]
    got = {(r.doc_id, r.item_id) for r in decontam.leaks(df, spark.createDataFrame(test, "item_id long, text string, doc_id string"), max_broadcast_seeds=most).collect()}
    want = {(d, i) for d, t in enumerate(docs[:-1]) for i, x, _ in test if brute(t, x)} | {(len(docs) - 1, 10)}
    assert got == want and len(want) > 50


def test_rows_and_empty_tables(spark):
    text = "one two three four five six seven eight"
    test = spark.createDataFrame([(1, text)], "item_id long, text string")
    docs = spark.createDataFrame([(None, text, 1), (3, text, 2), (3, text, 2), (4, "clean", 0)], "doc_id long, text string, seed int")
    assert sorted((r.doc_id or -1, r.matched) for r in decontam.leaks(docs, test).collect()) == [(-1, 8), (3, 8), (3, 8)]
    kept = decontam.clean(docs, test)
    assert kept.columns == docs.columns and [r.doc_id for r in kept.collect()] == [4]
    assert sorted(r.doc_id or -1 for r in decontam.clean(docs, test, max_broadcast_seeds=0).collect()) == [4]
    assert decontam.leaks(docs.limit(0), test).collect() == []
    assert decontam.leaks(docs, test.limit(0)).collect() == [] and decontam.clean(docs, test.limit(0)).count() == 4


@pytest.mark.parametrize("most", [10**6, 0])
def test_ids_decide_nothing(spark, most):
    text, other = "one two three four five six seven eight", "ten eleven twelve thirteen fourteen"
    test = spark.createDataFrame([(1, text), (1, other), (None, other)], "item_id long, text string")
    docs = spark.createDataFrame([(None, text), (None, "clean"), (3, text), (3, "also clean"), (3, other), (4, text), (4, text), (5, None), (None, None)], "doc_id long, text string")
    rows = sorted(((r.doc_id or -1), r.item_id or -1, r.matched) for r in decontam.leaks(docs, test, max_broadcast_seeds=most).collect())
    assert rows == [(-1, 1, 8), (3, -1, 5), (3, 1, 5), (3, 1, 8), (4, 1, 8), (4, 1, 8)]
    kept = decontam.clean(docs, test, max_broadcast_seeds=most)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id or -1), r.text or "") for r in kept.collect()) == [(-1, ""), (-1, "clean"), (3, "also clean"), (5, "")]
    assert decontam.clean(docs.limit(0), test, max_broadcast_seeds=most).collect() == []
    assert decontam.clean(docs, test.limit(0), max_broadcast_seeds=most).count() == docs.count()
