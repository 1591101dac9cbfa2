import random
import zlib

import duckdb
import pytest

from brute import sha
from forkcast.llm import oracles, prefix_trie
from forkcast.llm.queries import QUERIES

COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def rebuilt(rows):
    """(conv_id, turn, role, text) rows to {conv_id: [(role, text)]}, heads shared."""
    own = {}
    said = lambda r: sha(f"{len((r[2] or '').encode())}:{r[2] or ''}{r[3] or ''}")
    for r in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1], said(r))):
        own.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    out = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        out[c] = own.get(base, [])[:h] + mine[h:]
    return out


def brute(convs):
    nodes = {}
    for c, seq in sorted(convs.items()):
        for d in range(len(seq) + 1):
            nodes.setdefault(tuple(seq[:d]), []).append(c)
    children = {}
    for path in nodes:
        if path:
            children.setdefault(path[:-1], []).append(path)

    out, total = [], {}
    for path in sorted(nodes, key=len, reverse=True):
        below = [total[x] for x in children.get(path, [])]
        saved = (len(nodes[path]) - 1) * len(path[-1][1].encode()) if path else 0
        total[path] = (sum(a for a, _ in below) or 1, saved + sum(b for _, b in below))
        ends = ",".join(str(c) for c in nodes[path] if len(convs[c]) == len(path))
        out.append((min(nodes[path]), len(path), min(nodes[path[:-1]]) if path else None, len(nodes[path]), len(children.get(path, [])), *total[path], sha(ends)))
    return sorted(out, key=lambda r: r[:2])


def trie(df, heads=True):
    said = prefix_trie.turns(df)
    said, convs = prefix_trie.share_heads(said) if heads else (said, df)
    got = prefix_trie.digests(*prefix_trie.build(said, convs)).select(*COLUMNS).collect()
    return sorted((tuple(r) for r in got), key=lambda r: r[:2])


def test_query_against_sql_and_brute_force(spark):
    path = "/root/testdata/sf0.01"
    got = sorted((tuple(r[c] for c in COLUMNS) for r in QUERIES["op11_prefix_trie"](spark, path).collect()), key=lambda r: r[:2])
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{path}/conversations.parquet'")
    want = sorted(con.execute(f"select {', '.join(COLUMNS)} from ({oracles.PREFIX_TRIE})").fetchall(), key=lambda r: r[:2])
    assert got == want
    assert got == brute(rebuilt(con.execute("select conv_id, turn, role, text from conversations").fetchall()))


@pytest.mark.parametrize("most", [5, 37])
def test_odd_conversations(spark, most):
    rng = random.Random(most)
    rows = []
    for c in range(-7, 40):
        rows += [(c, rng.choice([None, 3, t, t]), rng.choice(["user", None, ""]), rng.choice(["a", "b", "", None, "é👍"]), "x", 9) for t in range(rng.randrange(0, most + 1))]
    rows += [(c, t, "user", "same", None, 9) for c in (50, 51, 52, 53, 54, 2**60) for t in range(most)]
    rows += [(None, 0, "user", "of none", None, 9), (60, 0, "user", "z" * 300_000, None, 9)] + [(61, 0, "user", "again", None, 9)] * 20
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, node string, position int").repartition(5)
    assert trie(df) == brute(rebuilt([r[:4] for r in rows]))


def test_turnless_conversations_and_empty_tables(spark):
    turns = spark.createDataFrame([(1, 0, "user", "a"), (2, 0, "user", "a"), (2, 1, "user", "b")], "conv_id long, turn long, role string, text string")
    convs = spark.createDataFrame([(0,), (0,), (1,), (2,), (None,)], "conv_id long")
    nodes, ends = prefix_trie.build(prefix_trie.turns(turns), convs)
    assert sorted(tuple(r)[1:] for r in nodes.collect()) == [(0, 0, None, 3, 1, 1, 1), (1, 1, 0, 2, 1, 1, 1), (2, 2, 1, 1, 0, 1, 0)]
    assert sorted((r.conv_id, r.n) for r in ends.collect()) == [(0, 0), (1, 1), (2, 2)]
    nodes, _ = prefix_trie.build(prefix_trie.turns(turns.limit(0)), convs)
    assert [tuple(r)[1:] for r in nodes.collect()] == [(0, 0, None, 3, 0, 1, 0)]
    assert trie(turns.limit(0)) == []
