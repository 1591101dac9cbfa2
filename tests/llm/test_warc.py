import hashlib
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from forkcast.llm import oracles, warc
from forkcast.llm.queries import QUERIES
from forkcast.sources.sinks import scratch_path

COLUMNS = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "position")
MARK = "\r\n\r\nWARC/1.1\r\n"


def test_query_against_sql(spark):
    path = "/root/testdata/sf0.01"
    got = sorted(tuple(r[c] for c in COLUMNS) for r in QUERIES["op13_warc_index"](spark, path).collect())
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{path}/pages.parquet'")
    assert got == sorted(con.execute(f"select {', '.join(COLUMNS)} from ({oracles.WARC})").fetchall())


def odd_pages():
    rng = random.Random(5)
    texts = ["", None, "short", "a" * 99, "b" * 100, "é" * 60, "x" * 300_000, MARK * 20, "WARC/1.1\r\nWARC-Type: response\r\n" * 9, "tail\r\n\r\nWARC/1.1" * 9, "end" * 50 + "\r\n\r\n", "\r\n" * 60,
             "WARC" * 40 + "/1.1", "line\n" * 40, "WARC/1.1"]
    urls = [None, "", "no scheme", "http://A.Example.com/x?y#z", "https://example.com", "http://b.example.com/\r\nWARC-Type: x", "http://example.com/é", "ftp://[::1]:80/"]
    rows = [(i, rng.choice(urls), rng.choice(texts)) for i in range(300)]
    rows += [(None, "http://example.com/n", t) for t in ("b" * 100, "of no id " * 20, None)] + [(7, "http://example.com/again", "b" * 100), (-3, None, "\r\n" * 60)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("split", [None, 4096, 1013])
def test_round_trip_of_odd_pages(spark, split):
    rows = odd_pages()
    pages = spark.createDataFrame([(*r, "z", 1) for r in rows], "page_id long, url string, html string, payload string, size int").repartition(3)
    path = scratch_path(spark, "warc-test")
    warc.write(pages, path, warc.capture_date(F.lit(1577836800)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    if split:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    try:
        found = warc.materialize(warc.read(spark, path, payloads=True), "test")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    first = {}
    for i, _, t in rows:
        if i is not None and len((t or "").encode()) >= 100:
            first[t] = min(first.get(t, i), i)
    want = []
    for i, u, t in rows:
        body = (t or "").encode()
        again = t in first and first[t] != i
        want.append((i, None if u is None else u.replace("\r", "%0D").replace("\n", "%0A"), body, len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response", first[t] if again else None))
    cols = [warc.page_number(F.col("record_id")).alias("page_id"), "url", "payload", "payload_bytes", "payload_digest", "record_type", warc.page_number(F.col("refers_to")).alias("refers_to")]
    key = lambda r: tuple((x is not None, x or type(x)()) if x is not None else (False,) for x in r)
    assert sorted((tuple(bytes(x) if isinstance(x, bytearray) else x for x in r) for r in warc.resolve(found).select(*cols).collect()), key=key) == sorted(want, key=key)
    assert {r.record_type for r in found.where("payload is null").collect()} == {"revisit"}


def test_empty_table(spark):
    path = scratch_path(spark, "warc-test")
    warc.write(spark.createDataFrame([], "page_id long, url string, html string"), path, warc.capture_date(F.lit(0)))
    assert warc.index(warc.read(spark, path)).collect() == []


def test_wrong_records_fail():
    with pytest.raises(ValueError, match="digest"):
        warc.parse(b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <a>\r\nWARC-Date: d\r\nWARC-Payload-Digest: sha256:00\r\nContent-Length: 20\r\n\r\nHTTP/1.1 200 OK\r\n\r\nx")


@pytest.mark.parametrize("k", [0, 1, 2, 3, 7, 16])
def test_loser_tree_merges_blocks(k):
    rng = random.Random(k)
    runs = [sorted((rng.choice("abc"), str(rng.randrange(30)), str(i), "t", None, i, "d") for i in range(rng.choice([1, 5, 60]))) for _ in range(k)]
    blocks = [b for r, entries in enumerate(runs) for b in warc._pack(iter(entries), r, lambda e: 0, 4)]
    blocks.sort(key=lambda b: (b["after_url_key"] is not None, b["after_url_key"], b["after_date"], b["after_record_id"], b["run"], b["seq"]) if b["after_url_key"] is not None
                else (False, "", "", "", b["run"], b["seq"]))
    got = list(warc.merged(blocks))
    assert [e[:3] for e in got] == sorted(e[:3] for entries in runs for e in entries) and len(got) == sum(map(len, runs))


@pytest.mark.parametrize("fan_in,block", [(2, 3), (32, 512)])
def test_index_is_in_order(spark, fan_in, block):
    rng = random.Random(9)
    rows = [("http://hot.example.com/", f"2020-01-01T00:00:{rng.randrange(60):02}Z", f"<urn:page:{i}>", "response", None, i, "d") for i in range(500)]
    rows += [(f"http://{rng.choice('abc')}.org/{rng.randrange(20)}", "2020", f"<urn:page:{i}>", "response", None, i, "d") for i in range(500, 1000)]
    rows += [(None, None, None, None, None, None, None)] * 3
    df = spark.createDataFrame([(*r, 1) for r in rows], "url string, date string, record_id string, record_type string, refers_to string, payload_bytes long, payload_digest string, run int").repartition(7)
    got = sorted(warc.index(df, fan_in, block).collect(), key=lambda r: r.position)
    assert [r.position for r in got] == list(range(len(rows)))
    order = [(r.url_key, r.date, r.record_id) for r in got]
    assert order == sorted(order) and sorted(r.payload_bytes or -1 for r in got) == sorted(r[5] or -1 for r in rows)
