"""Quality rules as a short-circuit cascade.

Every rule runs on a sample of the texts first; its cost (seconds a text) and
its selectivity (share of texts it rejects) decide the order: the most
rejections for the least time go first.  On the whole table a rule then sees
only the texts that the rules before it let through.  A text is kept if no
rule rejects it, so the order changes the work and never the verdict.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forkcast.llm.words import SPACED, Grams, Words, runs

SYMBOLS = b"#*$%&|<>"
WINDOW = 8


class Texts:
    """A run of texts: what rules measure, each thing once."""

    def __init__(self, data: np.ndarray, off: np.ndarray):
        self.data, self.off, self.n = data, off, len(off) - 1
        self._words = None

    @property
    def words(self) -> Words:
        if self._words is None:
            self._words = Words(self.data, self.off, SPACED)
        return self._words

    def some(self, rows: np.ndarray) -> Texts:
        """These rows alone."""
        if len(rows) == self.n:
            return self
        sizes = np.diff(self.off)[rows]
        off = np.concatenate([[0], np.cumsum(sizes)])
        take = np.repeat(self.off[rows] - off[:-1], sizes) + np.arange(off[-1])
        return Texts(self.data[take], off)

    def count(self, wanted: np.ndarray) -> np.ndarray:
        """Bytes of each text for which ``wanted`` holds."""
        total = np.concatenate([[0], np.cumsum(wanted)])
        return total[self.off[1:]] - total[self.off[:-1]]

    def bytes_in(self, values: bytes) -> np.ndarray:
        table = np.zeros(256, bool)
        table[list(values)] = True
        return self.count(table[self.data])

    def word_chars(self) -> np.ndarray:
        """Code points in words: bytes that don't continue one."""
        total = np.concatenate([[0], np.cumsum((self.data & 0xC0) != 0x80)])
        w = self.words
        return np.bincount(w.row, total[w.ends] - total[w.starts], self.n).astype(np.int64)

    def lines(self) -> tuple[np.ndarray, np.ndarray]:
        """Lines with a word, and those among them equal to an earlier one."""
        breaks = np.flatnonzero(self.data == 10)
        starts, ends = np.sort(np.concatenate([self.off[:-1], breaks + 1])), np.sort(np.concatenate([breaks, self.off[1:]]))
        w = self.words
        full = np.searchsorted(w.starts, ends) > np.searchsorted(w.starts, starts)
        starts, ends = starts[full], ends[full]
        row = np.searchsorted(self.off, starts, side="right") - 1
        h = w.spans_hash(starts, ends)
        order = np.lexsort((h, row))
        again = (h[order][1:] == h[order][:-1]) & (row[order][1:] == row[order][:-1])
        return np.bincount(row, minlength=self.n), np.bincount(row[order][1:][again], minlength=self.n)

    def repeated_words(self) -> np.ndarray:
        """Words in windows of WINDOW words that stand twice or more in the text."""
        w = self.words
        at, g = Grams(w, w.hashes()).windows(WINDOW)
        row = w.row[at]
        order = np.lexsort((g, row))
        same = (g[order][1:] == g[order][:-1]) & (row[order][1:] == row[order][:-1])
        twice = np.zeros(len(at), bool)
        twice[order[1:][same]] = twice[order[:-1][same]] = True
        covered = np.zeros(len(w.row) + 1, np.int64)
        covered[at[twice]] += 1
        np.add.at(covered, at[twice] + WINDOW, -1)
        return np.bincount(w.row[np.cumsum(covered)[:-1] > 0], minlength=self.n)


class Rule(NamedTuple):
    name: str
    rejects: Callable[[Texts], np.ndarray]


def few_words(t: Texts) -> np.ndarray:
    return t.words.counts < 20


def repeated_windows(t: Texts) -> np.ndarray:
    return 100 * t.repeated_words() > 30 * t.words.counts


def symbols(t: Texts) -> np.ndarray:
    """More than one of ``#*$%&|<>`` for four words."""
    return 4 * t.bytes_in(SYMBOLS) > t.words.counts


def duplicate_lines(t: Texts) -> np.ndarray:
    """Three lines or more, and over 30 % of all, repeat an earlier one."""
    lines, again = t.lines()
    return (again >= 3) & (100 * again > 30 * lines)


def stuttering(t: Texts) -> np.ndarray:
    """More than 30 % of the words repeat the word before them."""
    w, h = t.words, t.words.hashes()
    same = (h[1:] == h[:-1]) & (w.row[1:] == w.row[:-1])
    return 100 * np.bincount(w.row[1:][same], minlength=t.n) > 30 * w.counts


def shouting(t: Texts) -> np.ndarray:
    """More than half of the ASCII letters are capitals."""
    upper = t.count((t.data >= 65) & (t.data <= 90))
    return upper > t.count((t.data >= 97) & (t.data <= 122))


def word_length(t: Texts) -> np.ndarray:
    """Words of under 2 or over 15 characters on average."""
    chars = t.word_chars()
    return (chars < 2 * t.words.counts) | (chars > 15 * t.words.counts)


RULES = tuple(Rule(f.__name__, f) for f in (few_words, repeated_windows, symbols, duplicate_lines, stuttering, shouting, word_length))


def _try_rules(rules):
    """mapInArrow: (text) -> rule, texts, rejected, seconds."""
    def measure(batches):
        for batch in batches:
            for _, data, off in runs(batch.column(0)):
                found = []
                for rule in rules:
                    began = time.perf_counter()
                    found.append((len(off) - 1, int(rule.rejects(Texts(data, off)).sum()), time.perf_counter() - began))
                n, rejected, seconds = zip(*found)
                yield pa.RecordBatch.from_arrays([pa.array([r.name for r in rules]), pa.array(n, pa.int64()), pa.array(rejected, pa.int64()), pa.array(seconds, pa.float64())], names=["rule", "n", "rejected", "seconds"])
    return measure


def plan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text", sample_fraction: float = 0.01, sample_rows: int = 2000) -> list[tuple[Rule, float, float]]:
    """(rule, seconds a text, share rejected) in the order to run: by
    rejections per second on a sample of at most ``sample_rows`` texts.
    Without sampled texts the rules keep their order."""
    sample = docs.select(F.col(text_col).cast("string")).sample(fraction=sample_fraction, seed=11).limit(sample_rows)
    rows = (sample.mapInArrow(_try_rules(rules), "rule string, n long, rejected long, seconds double")
            .groupBy("rule").agg(F.sum("n").alias("n"), F.sum("rejected").alias("rejected"), F.sum("seconds").alias("seconds")).collect())
    seen = {r.rule: (r.seconds / r.n, r.rejected / r.n) for r in rows}
    measured = [(rule, *seen.get(rule.name, (0.0, 0.0))) for rule in rules]
    return sorted(measured, key=lambda m: -m[2] / max(m[1], 1e-12))


def _judge(order):
    """mapInArrow: (id, text) -> id, base measures, verdict."""
    def judge(batches):
        for batch in batches:
            for lo, data, off in runs(batch.column(1)):
                whole = Texts(data, off)
                kept = np.ones(whole.n, bool)
                for rule in order:
                    alive = np.flatnonzero(kept)
                    if len(alive):
                        kept[alive] = ~rule.rejects(whole.some(alive))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(lo, whole.n),
                    *(pa.array(np.asarray(x), pa.int64()) for x in (whole.words.counts, whole.word_chars(), whole.bytes_in(SYMBOLS), whole.lines()[1], whole.repeated_words())),
                    pa.array(kept),
                ], names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "kept"])
    return judge


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text",
          sample_fraction: float = 0.01, sample_rows: int = 2000) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and
    the cascade's verdict ``kept``; one row per input row.

    A null text counts as empty; an empty text, or one without words, has all
    counts 0 and fails ``few_words``.  Repeated rows and null ids are judged
    like any other; columns besides id and text are ignored.  An empty table
    gives an empty result.
    """
    order = [rule for rule, _, _ in plan(docs, rules, text_col, sample_fraction, sample_rows)]
    two = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return two.mapInArrow(_judge(order), "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, kept boolean")
