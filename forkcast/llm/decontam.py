"""Benchmark decontamination by spaced-seed hashing.

A seed is a fixed mask over consecutive words; it ignores the words at its
zeros, so a changed word there does not hide a match.  Masks of test items
and of training texts are hashed alike and joined; around every hit, text and
item are laid over each other and compared word by word.  A text leaks an
item if 80 % of some STRETCH words in a row agree or, for a shorter item, 80 %
of all its words.

No stretch that agrees so often escapes the masks: for every length and every
placing of the allowed substitutions at least one mask fits somewhere
(``tests/llm/test_decontam.py`` goes through all of them).

The test side is a table of fixed benchmark items.  While its seeds number at
most ``max_broadcast_seeds`` they travel to the tasks, and training texts
never leave theirs; beyond that, seeds of both sides meet in a shuffle join
and only texts with a hit are read again.  Texts go by their digest there, so
ids decide nothing and both ways give the same rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forkcast.llm.words import ALNUM, Words, lower_ascii, mix, runs
from forkcast.session import materialize

#: Words in a row that make a leak; shorter items must match as a whole.
STRETCH = 13
PERCENT = 80
#: Spaced seeds (1: the word counts).
MASKS = ("111101", "11011", "1111")
#: Items of fewer words are too common to show anything.
SHORTEST = 4


def allowed(length: int) -> int:
    """Substitutions that a stretch of so many words may have."""
    return length - -(-length * PERCENT // 100)


def masks_for(words: int) -> tuple[str, ...]:
    """The masks that hash an item of so many words: for short ones a block
    that the allowed substitutions must leave whole somewhere."""
    if words >= 8:
        return MASKS
    return ("1" * (words // (allowed(words) + 1)),) if words >= SHORTEST else ()


def _seeds(h: np.ndarray, row: np.ndarray, mask: str) -> tuple[np.ndarray, np.ndarray]:
    """(first word, hash) of every place of a mask within a row."""
    k = len(mask)
    if len(h) < k:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.flatnonzero(row[:len(row) - k + 1] == row[k - 1:])
    total = np.full(len(at), int(mask, 2) + (k << 32), np.uint64)
    for i, bit in enumerate(mask):
        if bit == "1":
            total = mix(total * np.uint64(0x9E3779B97F4A7C15) + h[at + i])
    return at, total


def _words(column: pa.Array):
    for lo, data, off in runs(column):
        words = Words(lower_ascii(data), off, ALNUM)
        yield lo, words, words.hashes()


def _test_seeds(batches):
    """mapInArrow: (item_id, text) -> item_id, its word hashes, its seeds (mask, place, hash)."""
    for batch in batches:
        for lo, words, h in _words(batch.column(1)):
            for r in range(len(words.counts)):
                own = h[words.first[r]:words.first[r + 1]]
                if len(own) < SHORTEST:
                    continue
                seeds = [_seeds(own, np.zeros(len(own), np.int8), m) for m in masks_for(len(own))]
                at, hashes = (np.concatenate(x) for x in zip(*seeds))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(lo + r, 1),
                    pa.array([own.view(np.int64)], pa.list_(pa.int64())),
                    pa.array([at.astype(np.int32)], pa.list_(pa.int32())),
                    pa.array([hashes.view(np.int64)], pa.list_(pa.int64())),
                ], names=["item_id", "words", "places", "seeds"])


def _overlap(text: np.ndarray, item: np.ndarray, shift: int) -> int:
    """Best number of agreeing words in a leaking stretch, when word 0 of the item lies on word ``shift`` of the text; 0 if none leaks."""
    lo, hi = max(0, -shift), min(len(item), len(text) - shift)
    need = min(STRETCH, len(item))
    if hi - lo < need:
        return 0
    same = text[lo + shift:hi + shift] == item[lo:hi]
    total = np.concatenate([[0], np.cumsum(same)])
    inside = total[need:] - total[:-need]
    ok = inside * 100 >= need * PERCENT
    if not ok.any():
        return 0
    covered = np.zeros(len(same) + 1, np.int64)
    at = np.flatnonzero(ok)
    np.add.at(covered, at, 1)
    np.add.at(covered, at + need, -1)
    return int(same[np.cumsum(covered)[:-1] > 0].sum())


class _Index:
    """Seeds of the test items (item_id, words, places, seeds), sorted by hash."""

    def __init__(self, rows):
        self.ids, words, places, seeds = zip(*rows)
        self.items = [np.array(x, np.int64).view(np.uint64) for x in words]
        self.item = np.repeat(np.arange(len(seeds)), [len(x) for x in seeds])
        self.place = np.concatenate([np.array(x, np.int64) for x in places])
        hashes = np.concatenate([np.array(x, np.int64) for x in seeds]).view(np.uint64)
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.item, self.place = hashes[order], self.item[order], self.place[order]
        self.masks = sorted({m for x in self.items for m in masks_for(len(x))})
        bits = min(24, len(self.hashes).bit_length() + 6)
        self.shift = np.uint64(64 - bits)
        self.coarse = np.zeros(1 << bits, bool)
        self.coarse[(self.hashes >> self.shift).astype(np.int64)] = True

    def hits(self, at: np.ndarray, seeds: np.ndarray):
        """(text word, item, item word) of all equal seeds."""
        near = np.flatnonzero(self.coarse[(seeds >> self.shift).astype(np.int64)])
        lo, hi = (np.searchsorted(self.hashes, seeds[near], side=s) for s in ("left", "right"))
        n = hi - lo
        which = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return np.repeat(at[near], n), self.item[which], self.place[which]


def _find(index: _Index, column: pa.Array):
    """(row, item, agreeing words) of every leak in a column of texts."""
    for lo, words, h in _words(column):
        found = set()
        for mask in index.masks:
            at, item, place = index.hits(*_seeds(h, words.row, mask))
            rows = words.row[at]
            found.update(zip(rows.tolist(), item.tolist(), (at - words.first[rows] - place).tolist()))
        best = {}
        for r, item, shift in found:
            matched = _overlap(h[words.first[r]:words.first[r + 1]], index.items[item], shift)
            if matched:
                best[r, item] = max(matched, best.get((r, item), 0))
        for (r, item), matched in sorted(best.items()):
            yield lo + r, item, matched


def _leaks(held):
    """mapInArrow: (doc_id, text) -> doc_id, item_id, matched, item_words for every leak."""
    def find(batches):
        index = _Index(held.value)
        for batch in batches:
            found = list(_find(index, batch.column(1)))
            if found:
                row, item, matched = zip(*found)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array(row)), pa.array([index.ids[i] for i in item], pa.int64()),
                    pa.array(matched, pa.int32()), pa.array([len(index.items[i]) for i in item], pa.int32()),
                ], names=["doc_id", "item_id", "matched", "item_words"])
    return find


def _text_seeds(masks: list[str]):
    """mapInArrow: (key, text) -> key, seed for every place of every mask."""
    def seeds(batches):
        for batch in batches:
            for lo, words, h in _words(batch.column(1)):
                for mask in masks:
                    at, hashes = _seeds(h, words.row, mask)
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(words.row[at] + lo)), pa.array(hashes.view(np.int64))], names=["key", "seed"])
    return seeds


def _verify(batches):
    """mapInArrow: (doc_id, text, item_id, words, places, seeds) -> leaks."""
    for batch in batches:
        for i in range(batch.num_rows):
            index = _Index([[batch.column(c)[i].as_py() for c in ("item_id", "words", "places", "seeds")]])
            for _, _, matched in _find(index, batch.column("text").slice(i, 1)):
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(i, 1), batch.column("item_id").slice(i, 1),
                    pa.array([matched], pa.int32()), pa.array([len(index.items[0])], pa.int32()),
                ], names=["doc_id", "item_id", "matched", "item_words"])


def _clean(held, place: int, names: list[str]):
    """mapInArrow: the rows whose text leaks nothing."""
    def clean(batches):
        index = _Index(held.value)
        for batch in batches:
            ok = np.ones(batch.num_rows, bool)
            ok[[row for row, _, _ in _find(index, batch.column(place))]] = False
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(ok)) for c in batch.columns], names=names)
    return clean


def _test_side(benchmark: DataFrame) -> tuple[DataFrame, int, list[str]]:
    """The items with their seeds, how many seeds there are, and their masks."""
    test = materialize(benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
                       .mapInArrow(_test_seeds, "item_id long, words array<long>, places array<int>, seeds array<long>"), "seeds")
    seeds, lengths = test.agg(F.sum(F.size("seeds")), F.collect_set(F.least(F.size("words"), F.lit(8)))).first()
    return test, seeds or 0, sorted({m for n in lengths for m in masks_for(n)})


def _digest(text: Column) -> Column:
    return F.sha2(text.cast("string").cast("binary"), 256)


def _shuffled(docs: DataFrame, test: DataFrame, masks: list[str], shape: str) -> DataFrame:
    """The leaks of docs (doc_id of any type, text) by joins of seeds."""
    docs = docs.where("text is not null").withColumn("key", _digest(F.col("text")))
    hits = docs.select("key", "text").mapInArrow(_text_seeds(masks), "key string, seed long").distinct()
    pairs = hits.join(test.select("item_id", F.explode("seeds").alias("seed")).distinct(), "seed").select("key", F.col("item_id").alias("hit_id")).distinct()
    return (docs.join(pairs, "key").join(test, F.col("hit_id").eqNullSafe(F.col("item_id")))
            .select("doc_id", "text", "item_id", "words", "places", "seeds").mapInArrow(_verify, shape))


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          max_broadcast_seeds: int = 2_000_000) -> DataFrame:
    """doc_id, item_id, matched (agreeing words), item_words: one row per text and leaked item.

    Words are runs of ASCII letters (A-Z lower-cased), digits and characters
    above 0x7F.  Null and empty texts leak nothing, and items of fewer than
    four words (or null ones) are leaked by nothing.  Rows that are there
    twice, or share an id, give their rows each, judged by their own texts; a
    null doc_id is carried through.  Items sharing an id are compared one by
    one.  Other columns are ignored; an
    empty table gives an empty result.
    """
    spark = docs.sparkSession
    shape = "doc_id long, item_id long, matched int, item_words int"
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    test, seeds, masks = _test_side(benchmark)
    if not seeds:
        return spark.createDataFrame([], shape)
    if seeds <= max_broadcast_seeds:
        return docs.mapInArrow(_leaks(spark.sparkContext.broadcast([tuple(r) for r in test.collect()])), shape)
    return _shuffled(docs, test, masks, shape)


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_broadcast_seeds: int = 2_000_000) -> DataFrame:
    """The rows of ``docs``, all columns, whose text leaks nothing.

    Every row is judged by its own text: null and empty texts leak nothing,
    rows with null or repeated ids go or stay each by itself, and repeated rows
    go together.  An empty table gives an empty result; an empty benchmark
    removes nothing."""
    test, seeds, masks = _test_side(benchmark)
    if not seeds:
        return docs
    if seeds <= max_broadcast_seeds:
        held = docs.sparkSession.sparkContext.broadcast([tuple(r) for r in test.collect()])
        return docs.mapInArrow(_clean(held, docs.columns.index(text_col), docs.columns), docs.schema)
    text = F.col(text_col).cast("string")
    bad = _shuffled(docs.select(_digest(text).alias("doc_id"), text.alias("text")), test, masks, "doc_id string, item_id long, matched int, item_words int")
    bad = bad.select(F.col("doc_id").alias("leaking_text")).distinct()
    return docs.join(bad, _digest(docs[text_col]) == bad["leaking_text"], "left_anti")
