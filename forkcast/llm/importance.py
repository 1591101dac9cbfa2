"""Importance resampling towards a target distribution.

Texts are bags of hashed features: all runs of one to three words, each in one
of a fixed number of buckets.  A bucket's gain is the logarithm of its
smoothed share in the target over its share in the documents; a document's
weight is the sum of its features' gains, and a Gumbel number per document
added to it makes the highest scores a draw without replacement.

1. Both tables' buckets are counted: one vector of counts a task, summed.
2. The gains are an array of one number per bucket (a fixed size, whatever the
   tables), and documents are scored against it batch by batch in numpy.
3. The cutoff between drawn and undrawn is found without sorting all scores: a
   quantile sketch proposes a bracket, exact counts of what lies above and
   inside accept it or widen it, and only the bracket is sorted, by ranges and
   not in one task.  What lies above is sorted for its ranks alone.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forkcast.llm.words import ALNUM, Words, lower_ascii, runs
from forkcast.operators.ranks import with_position
from forkcast.session import materialize

#: Words up to this many bytes go through the tables below, others through zlib.
SHORT = 48


def _crc_tables() -> tuple[np.ndarray, np.ndarray]:
    """For a CRC register, which is linear over its bits:

    placed[n, b]: what byte b followed by n zero bytes adds to it;
    moved[n, k, v]: what value v in the register's byte k becomes after n bytes.
    """
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    step = lambda c: table[c & 255] ^ (c >> 8)
    placed = np.empty((SHORT + 2, 256), np.uint32)
    placed[0] = table
    moved = np.empty((SHORT + 2, 4, 256), np.uint32)
    moved[0] = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]
    for n in range(1, SHORT + 2):
        placed[n], moved[n] = step(placed[n - 1]), step(moved[n - 1])
    return placed, moved


_tables: list = []


def _move(register: np.ndarray, n: np.ndarray) -> np.ndarray:
    moved = _tables[1]
    return moved[n, 0, register & 255] ^ moved[n, 1, (register >> 8) & 255] ^ moved[n, 2, (register >> 16) & 255] ^ moved[n, 3, register >> 24]


def run_crcs(words: Words, longest: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For k = 1 .. longest: (row, crc32) of every run of k words of a row,
    the words joined by one space."""
    if not _tables:
        _tables.extend(_crc_tables())
    placed = _tables[0]
    starts, size = words.starts, words.ends - words.starts
    n = len(starts)
    if not n:
        return [(np.zeros(0, np.int64), np.zeros(0, np.uint32))] * longest
    short = size <= SHORT
    # every short word's own part: the exclusive or of its bytes' parts
    lengths = np.where(short, size, 0)
    total = int(lengths.sum())
    begin = np.cumsum(lengths) - lengths
    part = np.zeros(n, np.uint32)
    if total:
        which = np.repeat(np.arange(n), lengths)
        inside = np.arange(total) - begin[which]
        parts = placed[size[which] - 1 - inside, words.data[starts[which] + inside]]
        some = np.flatnonzero(lengths)
        part[some] = np.bitwise_xor.reduceat(parts, begin[some])
    at = np.where(short, size, 0)
    alone = part ^ _move(np.full(n, 0xFFFFFFFF, np.uint32), at) ^ np.uint32(0xFFFFFFFF)
    spaced = part ^ _move(np.full(n, placed[0, 32], np.uint32), at)  # after a space
    long = {int(i): words.data[starts[i]:words.ends[i]].tobytes() for i in np.flatnonzero(~short)}
    for i, word in long.items():
        alone[i] = zlib.crc32(word)
    out = [(words.row, alone)]
    crc = alone
    for k in range(2, longest + 1):
        # the run that starts at word i goes on with word i + k - 1
        if n < k:
            out.append((np.zeros(0, np.int64), np.zeros(0, np.uint32)))
            crc = np.zeros(0, np.uint32)
            continue
        crc = crc[:n - k + 1]
        more = _move(crc ^ np.uint32(0xFFFFFFFF), at[k - 1:] + 1) ^ spaced[k - 1:] ^ np.uint32(0xFFFFFFFF)
        for i, word in long.items():
            if i >= k - 1:
                more[i - k + 1] = zlib.crc32(word, zlib.crc32(b" ", int(crc[i - k + 1])))
        crc = more
        whole = words.row[:n - k + 1] == words.row[k - 1:]
        out.append((words.row[:n - k + 1][whole], crc[whole]))
    return out


def _features(texts: pa.Array, buckets: int, longest: int):
    """(first row, rows, words of each row, [(row, bucket)]) of each run of rows."""
    for lo, data, off in runs(texts):
        words = Words(lower_ascii(data), off, ALNUM)
        yield lo, len(off) - 1, words.counts, [(row, (crc % np.uint32(buckets)).astype(np.int64)) for row, crc in run_crcs(words, longest)]


def bucket_counts(texts: DataFrame, text_col: str = "text", buckets: int = 10_000, longest: int = 3) -> DataFrame:
    """(bucket, n): features of all texts; a bucket without any has no row.
    Null and empty texts have none, repeated rows count again."""
    def count(batches):
        sums = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, _, found in _features(batch.column(0), buckets, longest):
                for _, bucket in found:
                    sums += np.bincount(bucket, minlength=buckets)
        some = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(sums[some])], ["bucket", "n"])

    parts = texts.select(F.col(f"`{text_col}`").cast("string")).mapInArrow(count, "bucket long, n long")
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(documents: DataFrame, target: DataFrame, buckets: int = 10_000, scale: int = 1000) -> np.ndarray:
    """floor(scale * ln(share in target / share in documents)) per bucket,
    both smoothed by one; from (bucket, n) tables of at most ``buckets`` rows."""
    counts = []
    for table in (documents, target):
        n = [0] * buckets
        for bucket, k in table.collect():  # at most one row a bucket
            n[bucket] = k
        counts.append(n)
    s, t = counts
    all_s, all_t = sum(s), sum(t)
    return np.array([math.floor(scale * math.log((b + 1) * (all_s + buckets) / ((a + 1) * (all_t + buckets)))) for a, b in zip(s, t)], np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, text_col: str = "text", id_col: str = "doc_id", longest: int = 3) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every row; a text without
    words has no features and weight 0."""
    def score(batches):
        for batch in batches:
            n = batch.num_rows
            words, features, weight = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
            for lo, rows, counts, found in _features(batch.column(1), len(gain), longest):
                words[lo:lo + rows] = counts
                for row, bucket in found:
                    # rows are in order: sums over stretches, exact in integers
                    upto = np.concatenate([[0], np.cumsum(gain[bucket])])
                    ends = np.searchsorted(row, np.arange(rows + 1))
                    weight[lo:lo + rows] += upto[ends[1:]] - upto[ends[:-1]]
                    features[lo:lo + rows] += np.diff(ends)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words), pa.array(features), pa.array(weight)], ["doc_id", "n_words", "n_features", "weight"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`").cast("string")).mapInArrow(score, f"doc_id {kind}, n_words long, n_features long, weight long")


def gumbel(doc_id: Column, seed: int = 42, scale: int = 1000) -> Column:
    """floor(-scale * ln(-ln(u))), u from 32 bits of the id's SHA-256; a null
    id counts as the empty text."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-scale * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def bracket(scores: DataFrame, wanted: int, rows: int, accuracy: int = 1000) -> tuple[int, int, int]:
    """(low, high, above): the ``wanted``-th highest of ``rows`` scores
    (0 < wanted <= rows) lies from low to high, ``above`` scores lie above high.

    A sketch with rank error rows / accuracy proposes both ends; exact counts
    validate them, and an end that fails is moved out by twice the margin,
    down to the lowest or up to the highest score.
    """
    down = up = 2 / accuracy
    share = 1 - (wanted - 0.5) / rows
    low = high = None
    while True:
        ends = [max(share - down, 0.0), min(share + up, 1.0)]
        got = scores.agg(F.percentile_approx("score", ends, accuracy), F.min("score"), F.max("score")).first()
        low = got[1] if ends[0] == 0.0 else got[0][0]
        high = got[2] if ends[1] == 1.0 else got[0][1]
        above, inside = scores.agg(F.sum((F.col("score") > high).cast("long")), F.sum(F.col("score").between(low, high).cast("long"))).first()
        if above < wanted <= above + inside:
            return low, high, above
        if above >= wanted:
            up *= 2
        else:
            down *= 2


def resample(docs: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20, buckets: int = 10_000, longest: int = 3, seed: int = 42,
             scale: int = 1000, text_col: str = "text", id_col: str = "doc_id", accuracy: int = 1000) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of every row of
    ``docs``, all long but the id; rank counts the drawn from 1 and is null
    for the others.

    Of the N rows with ``least_words`` words, floor(percent * N / 100) are
    drawn: the highest scores, ties to the smaller id, null ids first; rows
    that share an id and a score are equal but for their texts, and those with
    fewer features come first.  Null texts count as empty; other columns are
    ignored; an empty table gives an empty result, and an empty target draws
    by shares in the documents alone.
    """
    gain = gains(bucket_counts(docs, text_col, buckets, longest), bucket_counts(target, text_col, buckets, longest), buckets, scale)
    scored = weigh(docs, gain, text_col, id_col, longest).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed, scale))
    scored = materialize(scored, "scores")
    fit = scored.where(F.col("n_words") >= least_words)
    rows = fit.count()
    wanted = percent * rows // 100
    unranked = F.lit(None).cast("long").alias("rank")
    if not wanted:
        return scored.select("*", unranked)
    low, high, above = bracket(fit, wanted, rows, accuracy)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_first(), F.col("n_features"), F.col("n_words")]
    around = with_position(fit.where(F.col("score").between(low, high)), [], order)
    at = F.col("position") + above + 1
    around = around.select(*scored.columns, F.when(at <= wanted, at).alias("rank"))
    over = with_position(fit.where(F.col("score") > high), [], order)
    over = over.select(*scored.columns, (F.col("position") + 1).alias("rank"))
    rest = scored.where((F.col("n_words") < least_words) | (F.col("score") < low)).select("*", unranked)
    return over.unionByName(around).unionByName(rest)
