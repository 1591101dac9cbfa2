import hashlib
import math
import random
import re
import zlib

import duckdb
import pyarrow as pa
import pytest

from brute import lower
from forkcast.llm import importance, oracles
from forkcast.llm.queries import QUERIES
from forkcast.llm.words import ALNUM, Words, lower_ascii, runs

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
COLUMNS = ("doc_id", "n_words", "n_features", "weight", "score", "rank")


def grams(text):
    w = WORD.findall(lower(text))
    return len(w), [zlib.crc32(" ".join(w[i:i + k]).encode()) for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def brute(docs, target, percent=5, buckets=10_000, least=20):
    def count(texts):
        n = [0] * buckets
        for t in texts:
            for c in grams(t)[1]:
                n[c % buckets] += 1
        return n, sum(n)

    (s, all_s), (t, all_t) = count(x for _, x in docs), count(target)
    gain = [math.floor(1000 * math.log((b + 1) * (all_s + buckets) / ((a + 1) * (all_t + buckets)))) for a, b in zip(s, t)]
    rows = []
    for i, text in docs:
        words, found = grams(text)
        weight = sum(gain[c % buckets] for c in found)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, words, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    fit = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is not None, r[0] or 0, r[2], r[1]))
    drawn = percent * len(fit) // 100
    out = [(*r, i + 1 if i < drawn else None) for i, r in enumerate(fit)] + [(*r, None) for r in rows if r[1] < least]
    return sorted(out, key=key)


def key(r):
    return tuple((x is not None, x or 0) for x in r)


def test_checksums_of_word_runs():
    rng = random.Random(1)
    texts = ["", "a", "a b", "x" * 500, "one " + "y" * 49 + " two " + "z" * 48 + " " + "q" * 4000 + " three", "été 東京 o'clock 7"]
    texts += [" ".join("w" * rng.choice([1, 3, 47, 48, 49, 50, 90]) + str(rng.randrange(9)) for _ in range(rng.randrange(9))) for _ in range(60)]
    got = {}
    for lo, data, off in runs(pa.array(texts), 700):
        for found in importance.run_crcs(Words(lower_ascii(data), off, ALNUM), 4):
            for r, c in zip(*found):
                got.setdefault(lo + int(r), []).append(int(c))
    for i, t in enumerate(texts):
        w = WORD.findall(t)
        assert sorted(got.get(i, [])) == sorted(zlib.crc32(" ".join(w[j:j + k]).encode()) for k in (1, 2, 3, 4) for j in range(len(w) - k + 1))


def test_query_against_sql_and_brute_force(spark):
    path = "/root/testdata/sf0.01"
    got = sorted((tuple(r[c] for c in COLUMNS) for r in QUERIES["op12_importance_resampling"](spark, path).collect()), key=key)
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"create view {name} as select * from '{path}/{name}.parquet'")
    assert got == brute(con.execute("select doc_id, text from documents").fetchall(), [t for t, in con.execute("select text from benchmark").fetchall()])
    assert got == sorted(con.execute(f"select {', '.join(COLUMNS)} from ({oracles.IMPORTANCE})").fetchall(), key=key)


@pytest.mark.parametrize("accuracy", [1000, 1])
def test_odd_rows(spark, accuracy):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(30)] + ["Été", "x" * 60]
    docs = [(rng.choice([None, i, 7]), " ".join(rng.choice(words) for _ in range(rng.choice([0, 3, 19, 20, 40, 200])))) for i in range(300)]
    docs += [(5, None), (6, ""), (8, "same words here " * 9), (8, "same words here " * 9), (9, "long " * 30_000)] + [(900, "one text many times over " * 6)] * 200
    rng.shuffle(docs)
    target = [None, "", "w1 w2 w3 été same words"]
    df = spark.createDataFrame([(*d, 1, "z") for d in docs], "doc_id long, text string, score int, position string").repartition(7)
    test = spark.createDataFrame([(t,) for t in target], "text string")
    got = importance.resample(df, test, percent=30, accuracy=accuracy)
    assert sorted((tuple(r[c] for c in COLUMNS) for r in got.collect()), key=key) == brute(docs, target, 30)
    if accuracy > 1:
        assert sorted((tuple(r) for r in importance.resample(df, test.limit(0), percent=100).collect()), key=key) == brute(docs, [], 100)
        assert importance.resample(df.limit(0), test).collect() == []
