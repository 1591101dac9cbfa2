"""WARC archives and their capture index.

``write`` turns pages into WARC/1.1 records through Spark's own text writer,
so archives go to any file system that Spark writes to, one file a task.  Of
equal payloads one is kept (a response), the others are revisit records that
refer to it.  ``read`` splits archives at record marks, a file in as many tasks
as its size asks for, and takes every record by its declared lengths.  A
payload in which a mark could be seen is sent in HTTP chunks that break it.

``index`` orders captures by URL key and timestamp, by external merging:

1. Every task sorts its captures and writes them as a run, packed into blocks.
   Key ranges (cut points from a sample) end blocks, so every range can be
   merged by itself.
2. Up to ``fan_in`` runs of a range are merged by a loser tree in one task,
   which holds one block a run: a block comes in when the run's last one is
   used up, because blocks are dealt in the order of the keys before them.
   Rounds are repeated until one run is left, each written to the shared
   checkpoint folder.
3. A range's place in the whole comes from the counts of those before it.
"""

from __future__ import annotations

import bisect
import hashlib
import itertools
import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from forkcast.session import materialize

VERSION, BREAK = "WARC/1.1", "\r\n"
END = BREAK * 2
#: Payloads of fewer bytes are never stored as revisits.
LEAST_BYTES = 100
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def capture_date(seconds: Column) -> Column:
    """WARC-Date of seconds since 1970."""
    return F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit(BREAK))


def _record_id(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">"))


def records(pages: DataFrame, date: Column, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """(value): the WARC record of every row, without the empty line that ends it.

    Of rows with equal payloads of at least LEAST_BYTES bytes, those with the
    smallest id are responses, the others revisits; shorter payloads are all
    responses.  Null payloads count as empty; rows with a null id are revisits
    of an equal payload that has one, and responses otherwise; a null url gives
    a record without target, line breaks in a url are percent-encoded.  Other
    columns are ignored.
    """
    payload = F.coalesce(F.col(f"`{payload_col}`").cast("string"), F.lit(""))
    url = F.replace(F.replace(F.col(f"`{url_col}`").cast("string"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    rows = pages.select(F.col(f"`{id_col}`").alias("page_id"), url.alias("url"), payload.alias("payload"), date.alias("date"), F.sha2(payload.cast("binary"), 256).alias("digest"))
    rows = rows.withColumn("size", F.octet_length("payload"))
    # narrow rows, combined before the shuffle; only repeated payloads go on
    first = rows.where(F.col("size") >= LEAST_BYTES).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    # written first, so its real size decides whether payloads have to move for the join
    first = materialize(first.where("n > 1 and first is not null").select("digest", "first"), "repeated")
    rows = rows.join(first, "digest", "left")
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    seen = F.col("payload").contains(VERSION)
    chunks = F.array_join(F.transform(F.split("payload", "(?<=WARC)(?=/1\\.1)", -1), lambda x: F.concat(F.hex(F.octet_length(x)), F.lit(BREAK), x, F.lit(BREAK))), "")
    sent = F.when(again | ~seen, _line("Content-Length", F.col("size").cast("string"))).otherwise(F.lit(f"Transfer-Encoding: chunked{BREAK}"))
    body = F.when(again, F.lit("")).when(seen, F.concat(chunks, F.lit("0" + END))).otherwise(F.col("payload"))
    block = F.concat(F.lit(f"HTTP/1.1 200 OK{BREAK}Content-Type: text/html;charset=utf-8{BREAK}"), sent, F.lit(BREAK), body)
    rows = rows.select("page_id", "url", "date", "digest", "first", again.alias("again"), block.alias("block"))
    refers = F.when(F.col("again"), F.concat(_line("WARC-Profile", F.lit(PROFILE)), _line("WARC-Refers-To", _record_id(F.col("first"))))).otherwise(F.lit(""))
    return rows.select(F.concat(
        F.lit(VERSION + BREAK), _line("WARC-Type", F.when(F.col("again"), F.lit("revisit")).otherwise(F.lit("response"))), _line("WARC-Record-ID", _record_id(F.col("page_id"))),
        _line("WARC-Date", F.col("date")), F.coalesce(_line("WARC-Target-URI", F.col("url")), F.lit("")), _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")), refers,
        F.lit(f"Content-Type: application/http;msgtype=response{BREAK}"), _line("Content-Length", F.octet_length("block").cast("string")), F.lit(BREAK), F.col("block")).alias("value"))


def write(pages: DataFrame, path: str, date: Column, **columns: str) -> None:
    """The pages' records as archives in a folder (see ``records``)."""
    records(pages, date, **columns).write.mode("overwrite").text(path, lineSep=END)


def _unchunk(body: bytes) -> bytes:
    out, at = [], 0
    while True:
        stop = body.index(b"\r\n", at)
        size = int(body[at:stop].split(b";")[0], 16)
        if not size:
            return b"".join(out)
        out.append(body[stop + 2:stop + 2 + size])
        at = stop + 4 + size


def _fields(head: bytes) -> dict[str, str]:
    pairs = (line.partition(b":") for line in head.split(b"\r\n")[1:])
    return {name.strip().lower().decode(): value.strip().decode() for name, _, value in pairs}


def parse(record: bytes) -> dict:
    """What a record says; digest and size are those of the payload that was
    read, or for a revisit those that it declares of the payload it refers to."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = _fields(head if head.startswith(VERSION.encode()) else b"\r\n" + head)
    http, _, body = rest[:int(fields["content-length"])].partition(b"\r\n\r\n")
    sent = _fields(http)
    kind = fields["warc-type"]
    if kind == "revisit":
        body, size, digest = None, int(sent["content-length"]), fields["warc-payload-digest"].removeprefix("sha256:")
    else:
        body = _unchunk(body) if sent.get("transfer-encoding") == "chunked" else body
        size, digest = len(body), hashlib.sha256(body).hexdigest()
        if fields.get("warc-payload-digest", f"sha256:{digest}") != f"sha256:{digest}":
            raise ValueError(f"payload of {fields['warc-record-id']} does not match its digest")
    return {"record_id": fields["warc-record-id"], "record_type": kind, "refers_to": fields.get("warc-refers-to"), "url": fields.get("warc-target-uri"), "date": fields["warc-date"],
            "payload_bytes": size, "payload_digest": digest, "payload": body}


_CAPTURE = pa.schema([("record_id", pa.string()), ("record_type", pa.string()), ("refers_to", pa.string()), ("url", pa.string()), ("date", pa.string()),
                      ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())])
_NARROW = pa.schema([f for f in _CAPTURE if f.name != "payload"])
_DDL = "record_id string, record_type string, refers_to string, url string, date string, payload_bytes long, payload_digest string"


def read(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """The records of all archives in a folder, with payloads if asked for
    (null for revisits).  A record whose lengths or digest are wrong fails the
    job.  Records are split at marks, whatever the size of a file."""
    schema = _CAPTURE if payloads else _NARROW

    def parsed(batches):
        for batch in batches:
            found = [parse(value.as_py()) for value in batch.column(0)]
            yield pa.RecordBatch.from_pydict({f.name: [r[f.name] for r in found] for f in schema}, schema)

    # the mark begins with a character that is nowhere else in it: where a split
    # ends inside a mark that repeats its own beginning, a record can be lost
    marked = spark.read.text(path, lineSep="\n" + VERSION + BREAK)
    return marked.select(F.col("value").cast("binary")).mapInArrow(parsed, _DDL + (", payload binary" if payloads else ""))


def resolve(captures: DataFrame) -> DataFrame:
    """Captures read with payloads, revisits with the payload they refer to.

    Responses that revisits name are unique by id and payload, so the join has
    one row for each revisit; a hot one is split by AQE on the revisits' side.
    """
    again = captures.where("record_type = 'revisit'").drop("payload")
    kept = captures.where("record_type <> 'revisit'")
    named = kept.join(again.select(F.col("refers_to").alias("record_id"), "payload_digest").distinct(), ["record_id", "payload_digest"], "left_semi")
    named = named.groupBy(F.col("record_id").alias("refers_to"), "payload_digest").agg(F.first("payload").alias("payload"))
    return kept.unionByName(again.join(named, ["refers_to", "payload_digest"], "left"))


def url_key(url: Column) -> Column:
    """Sortable key of a url: host labels from the right, lower-cased, then
    path and query, without fragment; null is empty, a url without scheme is its own key."""
    rest = F.regexp_extract(url, r"(?s)^[^:/?#]*://([^/?#]*)([^#]*)", 2)
    host = F.lower(F.regexp_extract(url, r"(?s)^[^:/?#]*://([^/?#]*)", 1))
    key = F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), ","), F.lit(")"), rest)
    return F.coalesce(F.when(url.rlike(r"(?s)^[^:/?#]*://"), key).otherwise(url), F.lit(""))


# --- runs, blocks and the loser tree ---

class LoserTree:
    """Tournament of k heads: every inner node keeps the loser of its match,
    so a new head of the winner is played against one path of losers."""

    def __init__(self, heads: list):
        self.heads = [*heads, (-1,)]  # the last one loses to nothing while the tree fills
        self.losers = [len(heads)] * max(len(heads), 1)
        for i in reversed(range(len(heads))):
            self._play(i)

    def _play(self, i: int) -> None:
        heads, losers = self.heads, self.losers
        at = (i + len(losers)) // 2
        while at > 0:
            if heads[losers[at]] < heads[i]:
                i, losers[at] = losers[at], i
            at //= 2
        losers[0] = i

    @property
    def winner(self) -> int:
        return self.losers[0]

    def replace(self, head) -> None:
        """The winner's source goes on with ``head``."""
        i = self.losers[0]
        self.heads[i] = head
        self._play(i)


#: What an index entry holds; the first three are its order.
ENTRY = ["url_key", "date", "record_id", "record_type", "refers_to", "payload_bytes", "payload_digest"]
_BLOCK = pa.schema([("run", pa.int64()), ("part", pa.int64()), ("seq", pa.int64()), ("start", pa.int64()), ("size", pa.int64()),
                    *((f"after_{c}", pa.string()) for c in ENTRY[:3]), *((c, pa.list_(pa.int64() if c == "payload_bytes" else pa.string())) for c in ENTRY)])
_BLOCK_DDL = ("run long, part long, seq long, start long, size long, " + ", ".join(f"after_{c} string" for c in ENTRY[:3]) + ", "
              + ", ".join(f"{c} array<{'long' if c == 'payload_bytes' else 'string'}>" for c in ENTRY))
_EXHAUSTED = (1,)


def _pack(entries, run: int, part_of, size: int):
    """Ordered entries of a run to blocks, one range at a time; ``after_*`` is
    the key before the block in its run and range, null for the first one."""
    for part, inside in itertools.groupby(entries, part_of):
        last, start = (None, None, None), 0
        for seq in itertools.count():
            block = list(itertools.islice(inside, size))
            if not block:
                break
            yield {"run": run, "part": part, "seq": seq, "start": start, "size": len(block), **{f"after_{c}": v for c, v in zip(ENTRY, last)}, **{c: list(v) for c, v in zip(ENTRY, zip(*block))}}
            last, start = block[-1][:3], start + len(block)


def _entries(block: dict) -> list[tuple]:
    return list(zip(*(block[c] for c in ENTRY)))


def merged(blocks):
    """Entries of all runs of one range in order, from its blocks ordered by
    (after, run): first blocks of all runs, then each when its run needs it."""
    blocks = iter(blocks)
    sources, waiting = [], None
    for block in blocks:
        if block["after_url_key"] is not None:
            waiting = block
            break
        sources.append((block["run"], iter(_entries(block))))
    head = lambda run, entry: (0, *entry[:3], run, entry)
    tree = LoserTree([head(run, next(rest)) for run, rest in sources])
    while sources and tree.heads[tree.winner] is not _EXHAUSTED:
        run, rest = sources[tree.winner]
        yield tree.heads[tree.winner][-1]
        entry = next(rest, None)
        if entry is None and waiting is not None and waiting["run"] == run:
            rest = iter(_entries(waiting))
            sources[tree.winner] = (run, rest)
            waiting, entry = next(blocks, None), next(rest)
        tree.replace(_EXHAUSTED if entry is None else head(run, entry))


def _rows(batches):
    for batch in batches:
        yield from batch.to_pylist()


def _batches(blocks, many: int = 64):
    while some := list(itertools.islice(blocks, many)):
        yield pa.RecordBatch.from_pylist(some, _BLOCK)


def index(captures: DataFrame, fan_in: int = 32, block: int = 512, range_size: int = 4_000_000) -> DataFrame:
    """(position, url_key, date, record_id, record_type, refers_to,
    payload_bytes, payload_digest): all captures in the order of URL key,
    timestamp and record id, position from 0.

    Rows equal in these three take neighbouring places in any order; nulls
    sort as empty texts; other columns are ignored; an empty table gives an
    empty index.  The cut points of key ranges (one for every ``range_size``
    captures, from a sample four times as large) are all that the driver sees.
    """
    spark = captures.sparkSession
    keyed = captures.select(url_key(F.col("url")).alias("url_key"), *[F.coalesce(c, F.lit("")).alias(c) for c in ENTRY[1:3]], *ENTRY[3:])
    keyed = materialize(keyed, "captures")
    total = keyed.count()
    parts = max(spark.sparkContext.defaultParallelism, math.ceil(total / range_size))
    every = max(total // (4 * parts), 1)
    sample = sorted(tuple(r) for r in keyed.select(*ENTRY[:3]).where(F.pmod(F.xxhash64(*ENTRY[:3]), F.lit(every)) == 0).distinct().collect())
    cuts = sorted({sample[i * len(sample) // parts] for i in range(1, parts)}) if sample else []

    def as_run(batches):
        rows = _rows(batches)
        head = next(rows, None)
        if head is not None:
            entries = (tuple(r[c] for c in ENTRY) for r in itertools.chain([head], rows))
            yield from _batches(_pack(entries, head["run"], lambda e: bisect.bisect_right(cuts, e[:3]), block))

    runs = keyed.withColumn("run", F.spark_partition_id().cast("long")).sortWithinPartitions(*ENTRY[:3])
    runs = materialize(runs.mapInArrow(as_run, _BLOCK_DDL), "runs")

    def as_one(batches):
        for (part, group), blocks in itertools.groupby(_rows(batches), lambda b: (b["part"], b["group"])):
            yield from _batches(_pack(merged(blocks), group, lambda _, part=part: part, block))

    while (runs.agg(F.max("run")).first()[0] or 0) > 0:
        dealt = runs.withColumn("group", F.floor(F.col("run") / fan_in)).repartition("part", "group")
        dealt = dealt.sortWithinPartitions("part", "group", *[F.col(f"after_{c}").asc_nulls_first() for c in ENTRY[:3]], "run", "seq")
        runs = materialize(dealt.mapInArrow(as_one, _BLOCK_DDL), "runs")
    # one row a range, at most a row for every range_size captures
    before = runs.groupBy("part").agg(F.sum("size").alias("n"))
    before = before.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    entries = runs.join(F.broadcast(before), "part").select((F.col("before") + F.col("start")).alias("start"), F.posexplode(F.arrays_zip(*ENTRY)).alias("i", "e"))
    return entries.select((F.col("start") + F.col("i")).alias("position"), *[F.col(f"e.{c}").alias(c) for c in ENTRY])


def page_number(record_id: Column) -> Column:
    """The page id in a record id; null if there is none."""
    return F.regexp_extract(record_id, "^<urn:page:(.*)>$", 1).try_cast("long")


def digests(histories: DataFrame) -> DataFrame:
    """The index by page id."""
    return histories.select(page_number(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type", page_number(F.col("refers_to")).alias("refers_to"), "url_key", "position")
