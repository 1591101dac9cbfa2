"""Removal of passages that repeat across documents, with a count-min prefilter.

A window is ``length`` consecutive words.  It is cut from a document if its
word sequence also starts in a document with a smaller id.

First pass: every window gets a representative, the smallest hash among the
25-word sequences inside it.  Equal windows have equal representatives, and
neighbouring windows mostly share one, so there are about thirteen times fewer
of them.  Each task counts the representatives of its documents (once a
document) in a count-min sketch of four rows, and the sketches are merged,
32 at a time.  A cell is at least the number of documents with any
representative in it, so a window whose cells are below two is nowhere else:
overestimates cost work and never lose a repeat.

Second pass: only windows estimated repeated are grouped, exactly, by
representative and window hash (128 bits together), combined before the
shuffle, so a passage that very many documents share is a row a task.  What
comes back to a document are the first ids of its windows.

The sketch's width follows the number of representatives, up to
``most_bits``; beyond that more windows pass the filter and are grouped, and
nothing else changes.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forkcast.llm.words import SPACED, Grams, Words, mix, runs
from forkcast.session import materialize

ROWS, FINE_BITS = 4, 28
SHARDS = 16
#: Partial sketches that one task merges.
FAN_IN = 32
#: Repeated windows of one representative that go into one row.
LIST = 512


def _windows(words: Words, length: int):
    """(first word, row, representative, hash) of every window of a run."""
    h = words.hashes()
    grams = Grams(words, h)
    at, whole = grams.windows(length)
    inner = length // 2
    if not len(at):
        return at, at, whole, whole
    starts, g = grams.windows(inner)
    by_word = np.zeros(len(h), np.uint64)
    by_word[starts] = mix(g ^ np.uint64(0x632BE59BD9B4E019))
    span = length - inner + 1
    # smallest of each span: a running minimum doubled in width up to the span
    least, width = by_word, 1
    while 2 * width <= span:
        least = np.minimum(least[:len(least) - width], least[width:])
        width *= 2
    if width < span:
        least = np.minimum(least[:len(least) - (span - width)], least[span - width:])
    return at, words.row[at], least[at], whole


def _cells(representatives: np.ndarray) -> list[np.ndarray]:
    """The cell of each in every row of the sketch, at its finest width."""
    return [(mix(representatives ^ np.uint64(0xA0761D6478BD642F + i)) >> np.uint64(64 - FINE_BITS)).astype(np.uint32) for i in range(ROWS)]


def _packed(cells: np.ndarray) -> bytes:
    return zlib.compress(np.diff(cells, prepend=np.uint32(0)).tobytes(), 1)


def _unpacked(packed: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zlib.decompress(packed), np.uint32), dtype=np.uint32)


def _parts(row: int, once: np.ndarray, twice: np.ndarray):
    """The shards of a sketch row: cells met, and those met twice or more (both sorted)."""
    cuts = (np.arange(1, SHARDS, dtype=np.uint64) << np.uint64(FINE_BITS)) // np.uint64(SHARDS)
    for shard, (a, b) in enumerate(zip(np.split(once, np.searchsorted(once, cuts)), np.split(twice, np.searchsorted(twice, cuts)))):
        if len(a):
            yield row, shard, len(a), _packed(a), _packed(b)


def _sketch(length: int):
    """mapInArrow: (doc_id, text) -> the task's sketch in shards."""
    def sketch(batches):
        met: list[list[np.ndarray]] = [[] for _ in range(ROWS)]
        for batch in batches:
            known = np.asarray(batch.column(0).is_valid())
            for lo, data, off in runs(batch.column(1)):
                at, row, least, _ = _windows(Words(data, off, SPACED), length)
                if not len(at):
                    continue
                new = np.ones(len(at), bool)
                new[1:] = (least[1:] != least[:-1]) | (row[1:] != row[:-1])
                new &= known[lo + row]
                row, least = row[new], least[new]
                order = np.lexsort((least, row))
                row, least = row[order], least[order]
                new = np.ones(len(row), bool)
                new[1:] = (least[1:] != least[:-1]) | (row[1:] != row[:-1])
                for kept, cells in zip(met, _cells(least[new])):
                    kept.append(cells)
        found = []
        for i, kept in enumerate(met):
            if kept:
                cells, n = np.unique(np.concatenate(kept), return_counts=True)
                found += _parts(i, cells, cells[n > 1])
        if found:
            row, shard, size, once, twice = zip(*found)
            yield pa.RecordBatch.from_arrays([pa.array(row, pa.int32()), pa.array(shard, pa.int32()), pa.array(size, pa.int64()), pa.array(once, pa.binary()), pa.array(twice, pa.binary())], names=["row", "shard", "cells", "once", "twice"])
    return sketch


SKETCH = "row int, shard int, cells long, once binary, twice binary"


def _merge(part: pd.DataFrame) -> pd.DataFrame:
    """One sketch from up to FAN_IN of the same row and shard."""
    cells, n = np.unique(np.concatenate([_unpacked(x) for x in part["once"]]), return_counts=True)
    twice = np.union1d(cells[n > 1], np.concatenate([_unpacked(x) for x in part["twice"]]))
    return pd.DataFrame([(part["row"].iloc[0], part["shard"].iloc[0], len(cells), _packed(cells), _packed(twice))], columns=["row", "shard", "cells", "once", "twice"])


def _narrowed(bits: int):
    """A merged shard as a bitmap of its cells of at least two, at the width used."""
    def narrowed(part: pd.DataFrame) -> pd.DataFrame:
        out = []
        for x in part.itertuples():
            cells, n = np.unique(np.concatenate([_unpacked(x.once), _unpacked(x.twice)]) >> np.uint32(FINE_BITS - bits), return_counts=True)
            size = (1 << bits) // SHARDS
            full = np.zeros(size, bool)
            full[cells[n > 1].astype(np.int64) - int(x.shard) * size] = True
            out.append((x.row, x.shard, np.packbits(full).tobytes()))
        return pd.DataFrame(out, columns=["row", "shard", "full"])
    return narrowed


def repeated_cells(docs: DataFrame, length: int, most_bits: int) -> tuple[int, list[np.ndarray]]:
    """(bits, bitmaps): the merged sketch, as the cells that two or more
    documents meet.  Its size, at most ROWS * 2**most_bits / 8 bytes, is all
    that reaches the driver."""
    sketch = materialize(docs.mapInArrow(_sketch(length), SKETCH), "sketch")
    while True:
        parts, cells = sketch.groupBy("row", "shard").agg(F.count("*").alias("n"), F.sum("cells").alias("c")).agg(F.max("n"), F.sum("c")).first()
        if not parts or parts == 1:
            break
        numbered = sketch.withColumn("group", F.pmod(F.xxhash64("once", "twice"), F.lit(-(-parts // FAN_IN))))
        sketch = materialize(numbered.groupBy("row", "shard", "group").applyInPandas(lambda p: _merge(p.drop(columns="group")), SKETCH), "sketch")
    bits = max(12, min(most_bits, FINE_BITS, (4 * (cells or 0) // ROWS).bit_length()))
    maps = [np.zeros((1 << bits) // 8, np.uint8) for _ in range(ROWS)]
    size = len(maps[0]) // SHARDS
    rows = sketch.groupBy("row", "shard").applyInPandas(_narrowed(bits), "row int, shard int, full binary")
    for x in rows.collect():
        maps[x.row][x.shard * size:(x.shard + 1) * size] = np.frombuffer(x.full, np.uint8)
    return bits, maps


FOUND = "doc_id long, text_key long, n_words long, sha string, packed binary, runs array<struct<representative:long,start:int,windows:array<long>>>"


def _estimated(held, length: int):
    """mapInArrow: (doc_id, text) -> a row a document, with its windows
    estimated repeated, in runs of one representative, and then its text
    (packed, as it is written and shuffled once more)."""
    def find(batches):
        bits, maps = held.value
        for batch in batches:
            known = np.asarray(batch.column(0).is_valid())
            for lo, data, off in runs(batch.column(1)):
                words = Words(data, off, SPACED)
                n = len(off) - 1
                at, row, least, whole = _windows(words, length)
                new = np.ones(len(at), bool)
                new[1:] = (least[1:] != least[:-1]) | (row[1:] != row[:-1])
                first = np.flatnonzero(new)
                ok = known[lo + row[first]]
                for bitmap, cells in zip(maps, _cells(least[first])):
                    cell = cells >> np.uint32(FINE_BITS - bits)
                    ok &= (bitmap[cell >> np.uint32(3)] >> (7 - (cell & np.uint32(7))).astype(np.uint8) & 1).astype(bool)
                ok = np.repeat(ok, np.diff(np.append(first, len(at))))
                at, row, least, whole = at[ok], row[ok], least[ok], whole[ok]
                new = np.ones(len(at), bool)
                new[1:] = (least[1:] != least[:-1]) | (at[1:] != at[:-1] + 1) | (row[1:] != row[:-1])
                # a long run of one representative is cut, so rows stay short
                first = np.flatnonzero(new)
                since = np.arange(len(at)) - np.repeat(first, np.diff(np.append(first, len(at))))
                first = np.flatnonzero(new | (since % 64 == 0))
                lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(at)), pa.int32()), pa.array(whole.view(np.int64)))
                record = pa.StructArray.from_arrays([pa.array(least[first].view(np.int64)), pa.array((at[first] - words.first[row[first]]).astype(np.int32)), lists], names=["representative", "start", "windows"])
                each = pa.ListArray.from_arrays(pa.array(np.searchsorted(row[first], np.arange(n + 1)), pa.int32()), record)
                texts = [data[off[i]:off[i + 1]].tobytes() for i in range(n)]
                some = np.bincount(row[first], minlength=n) > 0
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(lo, n), pa.array(Grams(words, words.hashes()).rows().view(np.int64)), pa.array(words.counts, pa.int64()),
                    pa.array([hashlib.sha256(b" ".join(t.split())).hexdigest() for t in texts]),
                    pa.array([zlib.compress(t, 1) if s else None for t, s in zip(texts, some)], pa.binary()), each,
                ], names=["doc_id", "text_key", "n_words", "sha", "packed", "runs"])
    return find


def _cut(length: int):
    """mapInArrow: (doc_id, n_words, packed, starts) -> doc_id, n_words, n_removed, kept."""
    def cut(batches):
        for batch in batches:
            kept, removed = [], []
            for n, packed, starts in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3))):
                change = np.zeros(n + 1, np.int64)
                starts = np.unique(np.array([s for x in starts or [] for s in x], np.int64))
                np.add.at(change, starts, 1)
                np.add.at(change, starts + length, -1)
                gone = np.cumsum(change)[:-1] > 0
                words = zlib.decompress(packed).split()
                kept.append(b" ".join(w for w, g in zip(words, gone.tolist()) if not g).decode())
                removed.append(int(gone.sum()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(removed, pa.int64()), pa.array(kept, pa.string())], names=["doc_id", "n_words", "n_removed", "kept"])
    return cut


def repeats(docs: DataFrame, length: int = 50, most_bits: int = 28, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(documents without, documents with windows estimated repeated): the
    first as doc_id, n_words, sha (digest of all words), the second as doc_id,
    n_words, packed (text), starts (lists of the windows to cut, by first word)."""
    spark = docs.sparkSession
    two = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    held = spark.sparkContext.broadcast(repeated_cells(two, length, most_bits))
    found = materialize(two.mapInArrow(_estimated(held, length), FOUND), "windows")
    run = found.where(F.size("runs") > 0).select("doc_id", "text_key", F.explode("runs").alias("run"))
    run = run.select("doc_id", "text_key", "run.representative", "run.start", "run.windows")
    shared = (run.select("doc_id", "representative", F.explode("windows").alias("window")).groupBy("representative", "window")
              .agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last").drop("last"))
    shared = materialize(shared, "shared")
    size = shared.groupBy("representative").agg(F.ceil(F.count("*") / LIST).alias("lists"))
    lists = (shared.join(size, "representative").withColumn("list", F.pmod(F.xxhash64("window"), "lists"))
             .groupBy("representative", "list").agg(F.map_from_entries(F.collect_list(F.struct("window", "first"))).alias("first")))
    hits = run.join(lists, "representative").select(
        "doc_id", "text_key", F.filter(F.transform("windows", lambda w, i: F.when(F.element_at("first", w) < F.col("doc_id"), F.col("start") + i)), lambda x: x.isNotNull()).alias("starts"))
    hits = hits.where(F.size("starts") > 0).groupBy("doc_id", "text_key").agg(F.collect_list("starts").alias("starts"))
    without = found.where(F.size("runs") == 0).select("doc_id", "n_words", "sha")
    with_ = found.where(F.size("runs") > 0).select("doc_id", "text_key", "n_words", "packed").join(hits, ["doc_id", "text_key"], "left").select("doc_id", "n_words", "packed", "starts")
    return without, with_


def digests(docs: DataFrame, length: int = 50, most_bits: int = 28, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256; one row per input row.

    Windows are judged on the input; every word of a window that also starts
    in a document with a smaller id goes, the kept words are joined by one
    blank.  Null texts have no words, texts of fewer words than ``length`` no
    windows.  A null id is smaller than none and has no smaller one: such rows
    stay whole and take nothing from others.  Rows sharing an id are not
    smaller than each other.  Other columns are ignored; an empty table gives
    an empty result.
    """
    without, with_ = repeats(docs, length, most_bits, id_col, text_col)
    cut = with_.mapInArrow(_cut(length), "doc_id long, n_words long, n_removed long, kept string")
    return (without.select("doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"), F.col("sha").alias("kept_sha256"))
            .unionAll(cut.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))))
