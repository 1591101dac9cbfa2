import random

import duckdb
import pytest

from brute import SPACED, sha
from forkcast.llm import substring


def brute(rows, length):
    """rows: (id, text), ids may repeat -> sorted results."""
    first = {}
    for i, t in rows:
        w = SPACED.findall(t or "")
        for p in range(len(w) - length + 1):
            k = tuple(w[p:p + length])
            if i is not None:
                first[k] = min(i, first.get(k, i))
    out = []
    for i, t in rows:
        w = SPACED.findall(t or "")
        gone = set()
        for p in range(len(w) - length + 1):
            if i is not None and first[tuple(w[p:p + length])] < i:
                gone.update(range(p, p + length))
        out.append((i, len(w), len(gone), sha(" ".join(x for p, x in enumerate(w) if p not in gone))))
    return sorted(out, key=str)


def result(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in df.collect()), key=str)


@pytest.mark.parametrize("length,bits", [(50, 28), (6, 12)])
def test_against_brute_force(spark, length, bits):
    rng = random.Random(length)
    words = [f"w{i}" for i in range(40)] + ["été", "A,"]
    some = lambda n: [rng.choice(words) for _ in range(n)]
    passages = [some(n) for n in (length - 1, length, length + 1, 2 * length, 130)]
    rows = []
    for i in range(120):
        parts = [p for _ in range(rng.randrange(4)) for p in (some(rng.randrange(60)), rng.choice(passages))]
        rows.append((i, rng.choice([" ", "\n", " \t "]).join(w for p in parts for w in p)))
    rows += [(200, rows[3][1]), (200, rows[3][1]), (201, None), (202, ""), (None, " ".join(passages[4])), (None, None), (203, "a " * 3000), (204, "a " * 500), (7, " ".join(passages[3]))]
    rng.shuffle(rows)
    df = spark.createDataFrame([(i, t, 5, "x") for i, t in rows], "doc_id long, text string, start int, runs string").repartition(5)
    got = result(substring.digests(df, length, bits))
    want = brute(rows, length)
    assert got == want and sum(n for _, _, n, _ in want) > 500


def test_whole_table(spark):
    path = "/root/testdata/sf0.01/documents.parquet"
    rows = duckdb.sql(f"select doc_id, text from '{path}'").fetchall()
    assert result(substring.digests(spark.read.parquet(path))) == brute(rows, 50)


def test_nothing(spark):
    assert result(substring.digests(spark.createDataFrame([], "doc_id long, text string"))) == []
