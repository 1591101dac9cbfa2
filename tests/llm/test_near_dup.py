import random

import duckdb

from brute import components
from forkcast.llm import graph, lsh_forest


def run(spark, rows, percent=85):
    df = spark.createDataFrame(rows, "doc_id long, text string, rep long, a string")
    return {r.doc_id: r for r in lsh_forest.near_duplicates(df, least_percent=percent).collect()}


def test_planted_groups(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(4))
    docs = []
    for _ in range(12):
        base = [word() for _ in range(rng.choice([3, 6, 60, 200]))]
        for _ in range(rng.choice([1, 2, 5, 9])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = word()
            docs.append(" ".join(copy))
    rng.shuffle(docs)
    rows = [(i + 10, t) for i, t in enumerate([*docs, "", " \n", "One Two", "one\ttwo", "x" * 300_000])]
    got = run(spark, [(i, t, 1, "x") for i, t in [*rows, (1, None)]])
    want = components([*rows, (1, None)], 85)
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == want
    assert all(r.kept == (i == r.component_id) for i, r in got.items())


def test_whole_table_against_brute_force(spark):
    path = "/root/testdata/sf0.01/documents.parquet"
    rows = duckdb.sql(f"select doc_id, text from '{path}'").fetchall()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in lsh_forest.near_duplicates(spark.read.parquet(path)).collect()}
    assert got == components(rows, 85)


def test_nulls_repeats_and_nothing(spark):
    got = run(spark, [(None, "a b c d e f", 1, "")])
    assert got[None].component_id is None and got[None].kept
    got = run(spark, [(4, "a b c d e f", 1, ""), (4, "a b c d e f", 1, ""), (7, "A  b c d e f", None, None)])
    assert got[7].component_id == 4 and not got[7].kept
    assert run(spark, []) == {}


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 100), (5, 5), (None, 3)]
    got = {r.id: r.component for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 90: 90, 100: 90}


def test_ids_on_several_texts(spark):
    a, b, c, e = ("alpha beta gamma delta epsilon zeta", "one two three four five six", "red green blue cyan black white", "sun moon stars sky rain snow")
    rows = [(3, a), (5, a), (5, b), (7, b), (9, c), (9, e), (9, c), (1, None), (1, ""), (None, a), (None, a)]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, first_id string")
    kept = sorted((r.doc_id or -1, r.text or "") for r in lsh_forest.deduplicated(df).select("doc_id", "text").collect())
    assert kept == sorted([(3, a), (5, b), (9, c), (9, e), (1, ""), (-1, a), (-1, a)])
    got = {(r.doc_id, r.component_id, r.kept) for r in lsh_forest.near_duplicates(df).collect()}
    assert got == {(3, 3, True), (5, 3, False), (7, 3, False), (9, 9, True), (1, 1, True), (None, None, True)}


def test_deduplicated_keeps_one_of_near_texts_under_one_id(spark):
    base = [f"w{i}" for i in range(60)]
    near = " ".join(base[:-1] + ["other"])
    rows = [(9, " ".join(base)), (9, near), (9, near), (4, "no copy of this one anywhere here")]
    out = lsh_forest.deduplicated(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r.doc_id for r in out) == [4, 9]
    assert lsh_forest.deduplicated(spark.createDataFrame([], "doc_id long, text string")).collect() == []
