"""Secret scans through a trigram index.

Each rule's regex is turned into a Boolean query over the trigrams that a
match cannot do without.  Texts are indexed in segments (a run of a task's
rows, about a megabyte): every trigram that some query asks for has a posting
list of the segment's rows, the lists are intersected and united as the query
says, and only those rows are searched with the regex itself.  A rule without
mandatory trigrams scans every row.

Segments keep the index beside the text, so nothing is shuffled and a lost
task loses its own segments only.  The index is over ASCII-lower-cased text,
which can only add candidates.
"""

from __future__ import annotations

import re
from re import _constants as C
from re import _parser as P
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forkcast.llm.words import lower_ascii, runs


class Rule(NamedTuple):
    """A kind of secret.  ``group`` must have ``least`` characters or more,
    else the match is dropped (and its text is still used up)."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


BASE_RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]+", 0, 32),
)
MORE_RULES = (
    Rule("forge", r"\bgh[opusr]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"\bxox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("payment", r"\bsk_(?:live|test)_[A-Za-z0-9]{20,}"),
    Rule("jwt", r"\beyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----"),
)
RULES = BASE_RULES + MORE_RULES

#: Strings that a part of a regex may stand for, before it counts as anything.
MOST_STRINGS = 64


# -- trigram queries: True (no condition), ("and", ...), ("or", ...), or a trigram

def _all(*parts):
    parts = [p for p in dict.fromkeys(parts) if p is not True]
    return True if not parts else parts[0] if len(parts) == 1 else ("and", *parts)


def _any(*parts):
    parts = list(dict.fromkeys(parts))
    return True if True in parts else parts[0] if len(parts) == 1 else ("or", *parts)


def _of_strings(strings) -> object:
    """One of these strings stands in the text (a string that holds another one adds nothing)."""
    least = sorted(s for s in strings if not any(t != s and t in s for t in strings))
    return _any(*(_all(*(s[i:i + 3] for i in range(len(s) - 2))) for s in least))


def _characters(items) -> set[str] | None:
    """The lower-cased characters of a class, if they are few."""
    out = set()
    for op, value in items:
        if op is C.LITERAL:
            out.add(chr(value).lower())
        elif op is C.RANGE and value[1] - value[0] < 4:
            out |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
        else:
            return None
    return out if all(c.isascii() for c in out) else None


def _analyse(nodes):
    """(the strings that this sequence may be, or None; its query)."""
    run, query, exact = {""}, True, True

    def cut():
        nonlocal run, query, exact
        query, run, exact = _all(query, _of_strings(run)), {""}, False

    def follow(strings):
        nonlocal run
        if len(run) * len(strings) > MOST_STRINGS:
            cut()
        run = {a + b for a in run for b in strings}

    for op, value in nodes:
        if op is C.LITERAL and chr(value).isascii():
            follow({chr(value).lower()})
        elif op is C.IN and (found := _characters(value)) is not None:
            follow(found)
        elif op is C.SUBPATTERN or op is C.BRANCH or op is C.ATOMIC_GROUP:
            branches = value[1] if op is C.BRANCH else [value[-1] if op is C.SUBPATTERN else value]
            found = [_analyse(b) for b in branches]
            if all(s is not None for s, _ in found) and sum(len(s) for s, _ in found) <= MOST_STRINGS:
                follow(set().union(*(s for s, _ in found)))
            else:
                cut()
                query = _all(query, _any(*(q if s is None else _of_strings(s) for s, q in found)))
        elif op in (C.MAX_REPEAT, C.MIN_REPEAT, C.POSSESSIVE_REPEAT):
            low, high, body = value
            strings, inner = _analyse(body)
            if strings is not None and (low, high) in ((0, 1), (1, 1)):
                follow(strings | {""} if low == 0 else strings)
            else:
                if strings is not None and low:
                    follow(strings)
                cut()
                if low:
                    query = _all(query, inner)
        elif op is C.AT or op in (C.ASSERT, C.ASSERT_NOT):
            continue
        else:
            cut()
    return (run, _all(query, _of_strings(run))) if exact else (None, _all(query, _of_strings(run)))


def trigram_query(pattern: str):
    """A condition on trigrams of lower-cased text that every text with a match meets."""
    return _analyse(P.parse(pattern))[1]


def _trigrams(query) -> set[str]:
    return set() if query is True else {query} if isinstance(query, str) else set().union(*map(_trigrams, query[1:]))


class Segment:
    """Posting lists of the wanted trigrams over a run of rows."""

    def __init__(self, data: np.ndarray, off: np.ndarray, wanted: dict[str, int], table: np.ndarray):
        self.n, self.wanted = len(off) - 1, wanted
        low = lower_ascii(data).astype(np.int32)
        code = (low[:-2] << 16) | (low[1:-1] << 8) | low[2:]
        which = table[code]
        at = np.flatnonzero(which)
        row = np.searchsorted(off, at, side="right") - 1
        inside = at + 3 <= off[row + 1]
        self.pairs = np.unique(which[at][inside].astype(np.int64) * self.n + row[inside])

    def posting(self, trigram: str) -> np.ndarray:
        first = self.wanted[trigram] * self.n
        lo, hi = np.searchsorted(self.pairs, [first, first + self.n])
        return self.pairs[lo:hi] - first

    def rows(self, query) -> np.ndarray:
        """Rows that meet a query."""
        if query is True:
            return np.arange(self.n)
        if isinstance(query, str):
            return self.posting(query)
        found = self.rows(query[1])
        for part in query[2:]:
            if query[0] == "and" and not len(found):
                break
            found = (np.intersect1d if query[0] == "and" else np.union1d)(found, self.rows(part))
        return found


class Scanner:
    """Rules with their queries and the table of wanted trigrams."""

    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = [(i, r, re.compile(r.pattern, re.ASCII), trigram_query(r.pattern)) for i, r in enumerate(rules)]
        every = sorted(set().union(*(_trigrams(q) for *_, q in self.rules)))
        self.wanted = {t: i + 1 for i, t in enumerate(every)}
        self.table = np.zeros(1 << 24, np.uint16)
        for t, i in self.wanted.items():
            a, b, c = t.encode()
            self.table[a << 16 | b << 8 | c] = i

    def scan(self, texts: pa.Array):
        """(first row, [the (start, end, rule) spans of each row, sorted]) of each segment."""
        for lo, data, off in runs(texts):
            segment = Segment(data, off, self.wanted, self.table)
            spans: list[list] = [[] for _ in range(segment.n)]
            decoded: dict[int, str] = {}
            for i, rule, pattern, query in self.rules:
                for row in segment.rows(query).tolist():
                    text = decoded.get(row)
                    if text is None:
                        text = decoded[row] = data[off[row]:off[row + 1]].tobytes().decode()
                    spans[row] += [(m.start(), m.end(), i) for m in pattern.finditer(text) if m.end(rule.group) - m.start(rule.group) >= rule.least]
            for s in spans:
                s.sort(key=lambda x: (x[0], x[2], x[1]))
            yield lo, spans


SPANS = "array<struct<kind:string,start:long,end:long>>"


def _span_array(rules: tuple[Rule, ...], spans: list[list]) -> pa.Array:
    kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    return pa.array([[{"kind": rules[i].kind, "start": a, "end": b} for a, b, i in s] for s in spans], pa.list_(kind))


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, spans (kind, start, end in code points, by start, then as the
    rules are listed); one row per input row.

    A rule's matches are leftmost and non-overlapping; those of different
    rules may overlap.  Null and empty texts have no spans.  Null ids and
    repeated rows are carried through; other columns are ignored; an empty
    table gives an empty result.
    """
    def run(batches):
        scanner = Scanner(rules)
        for batch in batches:
            for lo, spans in scanner.scan(batch.column(1)):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, len(spans)), _span_array(rules, spans)], names=["doc_id", "spans"])

    two = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return two.mapInArrow(run, f"doc_id long, spans {SPANS}")


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs``, all columns, with every span of its text replaced by ``mark``
    (overlapping spans by one).  Null texts stay null and empty ones empty;
    ids decide nothing, repeated rows come out alike, an empty table stays
    empty."""
    place = docs.columns.index(text_col)
    names = docs.columns

    def covered(text: str, spans: list) -> str:
        out, done = [], 0
        for i, (a, b, _) in enumerate(spans):
            if a >= done:
                out += [text[done:a], mark]
            done = max(done, b)
        return "".join(out) + text[done:]

    def run(batches):
        scanner = Scanner(rules)
        for batch in batches:
            texts = batch.column(place)
            for lo, spans in scanner.scan(texts):
                part = batch.slice(lo, len(spans))
                column = part.column(place)
                if any(spans):
                    column = pa.array([covered(t.as_py(), s) if s else t.as_py() for t, s in zip(column, spans)], pa.string())
                columns = part.columns
                columns[place] = column.cast(pa.string())
                yield pa.RecordBatch.from_arrays(columns, names=names)

    fields = [T.StructField(f.name, T.StringType()) if i == place else f for i, f in enumerate(docs.schema.fields)]
    return docs.mapInArrow(run, T.StructType(fields))


def digests(found: DataFrame, base: tuple[Rule, ...] = BASE_RULES) -> DataFrame:
    """doc_id, n_<kind> of each base rule, base_sha256 and spans, from ``scan``'s rows."""
    kinds = [r.kind for r in base]
    text = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    joined = lambda spans: F.array_join(F.transform(spans, text), ",")
    of_kind = lambda k: F.filter("spans", lambda s: s["kind"] == k)
    counts = [F.size(of_kind(k)).cast("long").alias(f"n_{k}") for k in kinds]
    return found.select("doc_id", *counts, F.sha2(joined(F.filter("spans", lambda s: s["kind"].isin(kinds))), 256).alias("base_sha256"), joined("spans").alias("spans"))
