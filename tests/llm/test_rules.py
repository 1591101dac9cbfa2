import random
import re
from collections import Counter

import duckdb

from brute import SPACED
from forkcast.llm import rules_cascade
from forkcast.llm.queries import QUERIES


def brute(text):
    text = text or ""
    words = SPACED.findall(text)
    seen, dup = set(), 0
    lines = [x for x in text.split("\n") if SPACED.search(x)]
    for x in lines:
        dup += x in seen
        seen.add(x)
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    covered = {i + k for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for k in range(8)}
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    n, chars = len(words), sum(map(len, words))
    base = n < 20 or 100 * len(covered) > 30 * n
    upper, low = (len(re.findall(x, text)) for x in ("[A-Z]", "[a-z]"))
    stutters = sum(a == b for a, b in zip(words, words[1:]))
    more = 4 * symbols > n or dup >= 3 and 100 * dup > 30 * len(lines) or 100 * stutters > 30 * n or upper > low or chars < 2 * n or chars > 15 * n
    return n, chars, symbols, dup, len(covered), base, not base and not more


def texts():
    rng = random.Random(8)
    word = lambda: rng.choice(["a", "bb", "été", "Ünï", "##", "AAA", "x|y"])
    out = [None, "", "\n\n", "a\n", "\na", "a b\na b\r\na b\n", "one " * 30, "日本 " * 25, "x" * 100_000, "\n".join(["line of text here"] * 9)]
    for _ in range(200):
        part = [word() for _ in range(12)]
        out.append("".join(w + rng.choice([" ", "\n", "\t", "  "]) for w in [*part, *(word() for _ in range(rng.randrange(60))), *part[:rng.randrange(13)]]))
    return out


def check(rows, text_of):
    for r in rows:
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert got == brute(text_of[r.doc_id])[:5]


def test_odd_texts(spark):
    docs = dict(enumerate(texts()))
    df = spark.createDataFrame([(i, t, 1) for i, t in docs.items()], "doc_id long, text string, n_words int")
    rows = rules_cascade.judge(df, sample_fraction=1.0).collect()
    check(rows, docs)
    assert {r.doc_id: r.kept for r in rows} == {i: brute(t)[6] for i, t in docs.items()}
    assert rules_cascade.judge(df.limit(0)).collect() == []
    twice = spark.createDataFrame([(None, "a"), (None, "a")], "doc_id long, text string")
    assert [(r.doc_id, r.kept) for r in rules_cascade.judge(twice).collect()] == [(None, False)] * 2


def test_query_on_a_whole_table(spark):
    path = "/root/testdata/sf0.01"
    docs = dict(duckdb.sql(f"select doc_id, text from '{path}/documents.parquet'").fetchall())
    rows = QUERIES["op5_rules_cascade"](spark, path).collect()
    check(rows, docs)
    assert len(rows) == len(docs) and all((r.base_failed, r.kept) == brute(docs[r.doc_id])[5:] for r in rows)


def test_order_is_rejections_for_time(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    plan = rules_cascade.plan(df, sample_fraction=1.0)
    gain = [share / cost for _, cost, share in plan]
    assert gain == sorted(gain, reverse=True) and {r.name for r, _, _ in plan} == {r.name for r in rules_cascade.RULES}
    assert [r for r, *_ in rules_cascade.plan(df.limit(0))] == list(rules_cascade.RULES)
