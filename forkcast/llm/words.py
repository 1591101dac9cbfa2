"""Word hashes of Arrow text batches, without a Python loop over words.

A batch's UTF-8 bytes are handled in runs of whole rows of about a megabyte
(one longer row is a run of its own), so a task's memory follows its longest
text and not the batch.  Word boundaries come from a byte class: every class
used here treats all bytes above 0x7F alike, so no character is cut.

Hashes are 64-bit polynomials over random byte values, finished by a mixer.
``seed`` picks independent ones; two seeds make a 128-bit identity.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

RUN_BYTES = 1 << 20
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def _class(outside: list[tuple[int, int]]) -> np.ndarray:
    inside = np.ones(256, bool)
    for lo, hi in outside:
        inside[lo:hi + 1] = False
    return inside


#: [^\x20\x09-\x0D]+
SPACED = _class([(0x20, 0x20), (0x09, 0x0D)])
#: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of lower-cased text
ALNUM = _class([(0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)])


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finisher."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _byte_values(seed: int) -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(seed))


_powers_made: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64, for i up to n at least."""
    made = _powers_made.get(seed)
    if made is None or len(made[0]) <= n:
        size = max(n, 2 * RUN_BYTES) + 1
        base = _BASES[seed]
        made = ()
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            made += (np.multiply.accumulate(p),)
        _powers_made[seed] = made
    return made


def runs(texts: pa.Array, target: int = RUN_BYTES):
    """Yield (first row, bytes, row offsets) for consecutive runs of rows; null is the empty text."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    n = len(texts)
    if n == 0:
        return
    off = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + n + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(off, off[lo] + target, side="right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield lo, data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
        lo = hi


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data | np.uint8(32), data)


class Words:
    """The words of a run: ``starts`` and ``ends`` in bytes, the ``row`` of
    each, ``first`` (the words of row r are first[r]:first[r + 1]), and hashes."""

    def __init__(self, data: np.ndarray, off: np.ndarray, inside: np.ndarray):
        self.data, self.off = data, off
        keep = inside[data]
        before = np.zeros_like(keep)
        before[1:] = keep[:-1]
        before[off[:-1][off[:-1] < len(data)]] = False
        after = np.zeros_like(keep)
        after[:-1] = keep[1:]
        after[off[1:][off[1:] > 0] - 1] = False
        self.starts = np.flatnonzero(keep & ~before)
        self.ends = np.flatnonzero(keep & ~after) + 1
        self.first = np.searchsorted(self.starts, off)
        self.counts = np.diff(self.first)
        self.row = np.repeat(np.arange(len(off) - 1), self.counts)

    def spans_hash(self, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
        """Hash of each byte span."""
        power, inverse = _powers(len(self.data), seed)
        pre = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum(_byte_values(seed)[self.data] * power[:len(self.data)], out=pre[1:])
        return mix((pre[ends] - pre[starts]) * inverse[starts])

    def hashes(self, seed: int = 0) -> np.ndarray:
        return self.spans_hash(self.starts, self.ends, seed)


class Grams:
    """Hashes of word sequences, from word hashes ``h`` of a run."""

    def __init__(self, words: Words, h: np.ndarray, seed: int = 0):
        self.words, self.seed = words, seed
        power, self.inverse = _powers(len(h), seed)
        self.pre = np.zeros(len(h) + 1, np.uint64)
        np.cumsum(h * power[:len(h)], out=self.pre[1:])

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(first word, hash) of every window of k words within a row."""
        row = self.words.row
        if len(row) < k:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        at = np.flatnonzero(row[:len(row) - k + 1] == row[k - 1:])
        return at, mix((self.pre[at + k] - self.pre[at]) * self.inverse[at])

    def rows(self) -> np.ndarray:
        """Hash of every row's whole word sequence (its length counts too)."""
        f = self.words.first
        return mix((self.pre[f[1:]] - self.pre[f[:-1]]) * self.inverse[f[:-1]] + self.words.counts.astype(np.uint64) * np.uint64(0xA24BAED4963EE407))


def shingles(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct k-word shingles of every row, ordered by
    both; a row of fewer words has its whole sequence as one, an empty row none."""
    grams = Grams(words, words.hashes())
    at, g = grams.windows(k)
    row = words.row[at]
    short = np.flatnonzero((words.counts > 0) & (words.counts < k))
    if len(short):
        row, g = np.concatenate([row, short]), np.concatenate([g, grams.rows()[short]])
    order = np.lexsort((g, row))
    row, g = row[order], g[order]
    new = np.ones(len(g), bool)
    new[1:] = (g[1:] != g[:-1]) | (row[1:] != row[:-1])
    return row[new], g[new]
