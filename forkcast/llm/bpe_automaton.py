"""BPE encoding by a tokenization automaton, decoding by its arc labels.

The automaton reads tokens and accepts exactly the sequences that BPE makes.
It starts as one state with an arc for every base symbol.  Merges are added
in order, each by a gadget for (u, v) -> w:

- the state behind u gets a new version without its arc v, since u v is now w;
- w gets an arc from every state that still has the arc u;
- w leads to the state that v led to, as it was before this gadget.

A gadget adds one state.  States are stored by what tells them apart: whether
the state behind token s has the arc t follows from the merges on the right
edge of s and the left edge of t, each as old as the gadget that copied it.

Every prefix of a word has exactly one path from the start, so a word is read
from the left, place by place: the token that ends a prefix is the longest one
ending there whose arc leaves the state of the prefix before it.  The words of
a batch are read in lockstep over arrays: labels by a table of (node, byte)
steps, spelled from their ends, and arcs by a transition table of (state,
token), whose entries are worked out when first met and replaced one by one.
Decoding writes the labels of arcs.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Merges are numbered below this; a token that no merge ends lives until then.
NEVER = 1 << 30
#: Distinct words whose encoding a worker remembers.
REMEMBERED = 250_000
#: Entries of the transition table that a worker holds.
ARCS = 1 << 20
#: Words of more bytes are read one by one.
LOCKSTEP = 128
#: Texts whose words are read together, in characters.
TOGETHER = 1 << 20
#: Token ids are below 2**SHIFT.
SHIFT = 20
TOKENS = (1 << SHIFT) - 1


def byte_letters() -> list[str]:
    """The visible character that stands for each byte in a vocabulary:
    printable Latin-1 for itself, the others from U+0100 on, in order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(other)) for b in range(256)]


class Automaton:
    """The tokenization automaton of a vocabulary and its merges.

    Labels are spelled in symbols: a word's bytes (through ``letters``), and
    END behind the last one where the vocabulary marks word ends.  ``right``,
    ``left`` and ``born``: the parts of a token and the merge that makes it
    (-1: a base symbol); ``pairs`` and ``gadgets``: which merge takes an arc
    away, by the tokens before and on it."""

    END = 256

    def __init__(self, vocab: dict[str, int], end: str = "", parts=None, born=None, merge_of=None, letters: list[str] | None = None):
        self.vocab, self.end, self.parts, self.made, self.merge_of, self.letters = vocab, end, parts or {}, born or {}, merge_of or {}, letters
        self.edges: tuple[dict, dict] = {}, {}

    @classmethod
    def compiled(cls, vocab: dict[str, int], merges: list[tuple[str, str]], end: str = "", letters: list[str] | None = None) -> Automaton:
        """Gadget after gadget."""
        made = cls(dict(vocab), end, letters=letters)
        for k, (u, v) in enumerate(merges):
            if u in made.vocab and v in made.vocab and made._arc(vocab[u], vocab[v]):
                made._gadget(k, vocab[u], vocab[v], u + v)
            else:  # no state behind u has the arc v: no text comes to this merge
                del made.vocab[u + v]
        return made.ready()

    @property
    def states(self) -> int:
        return len(self.merge_of) + 1

    def _gadget(self, k: int, u: int, v: int, label: str) -> None:
        w = self.vocab[label]
        if w in self.parts:
            raise ValueError(f"two merges make token {label!r}")
        self.merge_of[u, v] = k
        self.parts[w] = u, v
        self.made[w] = k

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """The tokens on one edge of a token, each with the merge that ended its life there."""
        out = self.edges[side].get(token)
        if out is None:
            out, until, t = [(token, NEVER)], NEVER, token
            while t in self.parts:
                until = self.made[t]
                t = self.parts[t][side]
                out.append((t, until))
            self.edges[side][token] = out
        return out

    def _arc(self, s: int, t: int) -> bool:
        gone = self.merge_of.get
        left = self._edge(t, 0)
        for y, kept_y in self._edge(s, 1):
            for x, kept_x in left:
                k = gone((y, x))
                if k is not None and k < kept_y and (k < kept_x or k == kept_x and x == y):
                    return False
        return True

    def ready(self) -> Automaton:
        """The tables as arrays."""
        size = max([*self.vocab.values(), *self.parts, *(t for p in self.parts.values() for t in p), 0]) + 1
        self.left, self.right, self.born = (np.full(size, -1, np.int64) for _ in range(3))
        for w, (u, v) in self.parts.items():
            self.left[w], self.right[w], self.born[w] = u, v, self.made[w]
        keys = np.array([u << SHIFT | v for u, v in self.merge_of], np.int64)
        order = np.argsort(keys)
        self.pairs = keys[order]
        self.gadgets = np.array(list(self.merge_of.values()), np.int64)[order]
        # labels spelled from their ends: step[node, symbol] -> node, token[node]
        known = {c: i for i, c in enumerate(self.letters)} if self.letters else None
        nodes, tokens = {}, [-1]
        self.lengths = np.zeros(size, np.int64)  # in bytes
        cut = len(self.end)
        for label, i in self.vocab.items():
            ends = cut and label.endswith(self.end)
            body = label[:len(label) - cut] if ends else label
            symbols = [known[c] for c in body] if known else list(body.encode())
            self.lengths[i] = len(symbols)
            node = 0
            for x in reversed([*symbols, self.END] if ends else symbols):
                key = node << 9 | x
                node = nodes.get(key)
                if node is None:
                    node = nodes[key] = len(tokens)
                    tokens.append(-1)
            tokens[node] = i
        keys = np.fromiter(nodes, np.int64, len(nodes))
        order = np.argsort(keys)
        self.steps, self.targets, self.tokens = keys[order], np.fromiter(nodes.values(), np.int64, len(nodes))[order], np.array(tokens, np.int64)
        self.single = None  # the same tables for one word, when one is first met
        self.known_arcs = np.full(ARCS, -1, np.int64)  # (state, token, whether) in one number
        return self

    def _step(self, node: np.ndarray, symbol) -> np.ndarray:
        """Nodes behind a symbol, -1 where there is none."""
        key = node << 9 | symbol
        at = np.minimum(np.searchsorted(self.steps, key), len(self.steps) - 1)
        return np.where(self.steps[at] == key, self.targets[at], -1)

    def _arcs(self, s: np.ndarray, t: np.ndarray) -> np.ndarray:
        """Whether the states behind tokens s have the arcs t, walking down
        both edges side by side, the younger token first."""
        out = np.ones(len(s), bool)
        open_ = np.arange(len(s))
        y, x = s.copy(), t.copy()
        kept_y, kept_x = np.full(len(s), NEVER), np.full(len(s), NEVER)
        while len(open_):
            key = y << SHIFT | x
            at = np.minimum(np.searchsorted(self.pairs, key), max(len(self.pairs) - 1, 0))
            if len(self.pairs):
                k = np.where(self.pairs[at] == key, self.gadgets[at], NEVER)
                gone = (k < kept_y) & ((k < kept_x) | (k == kept_x) & (x == y))
                out[open_[gone]] = False
            else:
                gone = np.zeros(len(open_), bool)
            born_y, born_x = self.born[y], self.born[x]
            more = ~gone & ((born_y >= 0) | (born_x >= 0))
            open_, y, x, kept_y, kept_x, born_y, born_x = (z[more] for z in (open_, y, x, kept_y, kept_x, born_y, born_x))
            down = born_y >= born_x
            kept_y, kept_x = np.where(down, born_y, kept_y), np.where(down, kept_x, born_x)
            y, x = np.where(down, self.right[y], y), np.where(down, x, self.left[x])
        return out

    def allows(self, s: np.ndarray, t: np.ndarray) -> np.ndarray:
        """The same by the transition table."""
        key = s << SHIFT | t
        slot = ((key * 0x9E3779B1) >> 11) & (ARCS - 1)
        entry = self.known_arcs[slot]
        out = (entry & 1).astype(bool)
        new = np.flatnonzero(entry >> 1 != key)
        if len(new):
            _, first, again = np.unique(key[new], return_index=True, return_inverse=True)
            found = self._arcs(s[new[first]], t[new[first]])[again]
            out[new] = found
            self.known_arcs[slot[new]] = key[new] << 1 | found
        return out

    def encode(self, words: list[bytes]) -> list[bytes]:
        """Token ids (32 bits each) of words, none of them empty."""
        out: list = [None] * len(words)
        short = [i for i, w in enumerate(words) if len(w) <= LOCKSTEP]
        for lo in range(0, len(short), 1 << 16):
            some = short[lo:lo + (1 << 16)]
            for i, ids in zip(some, self._lockstep([words[i] for i in some])):
                out[i] = ids
        for i, w in enumerate(words):
            if out[i] is None:
                out[i] = self._alone(w)
        return out

    def _alone(self, word: bytes) -> bytes:
        """One long word, place by place."""
        if self.single is None:
            self.single = dict(zip(self.steps.tolist(), self.targets.tolist())), self.tokens.tolist(), self.lengths.tolist(), {}
        steps, tokens, lengths, arcs = self.single
        last, n = [], len(word)
        for j in range(n):
            node, found, i = steps.get(self.END, -1) if self.end and j == n - 1 else 0, [], j
            while node >= 0 and i >= 0:
                node = steps.get(node << 9 | word[i], -1)
                if node >= 0 and tokens[node] >= 0:
                    found.append(tokens[node])
                i -= 1
            for t in reversed(found):
                start = j - lengths[t]
                if start < 0:
                    break
                key = last[start] << SHIFT | t
                fits = arcs.get(key)
                if fits is None:
                    if len(arcs) >= ARCS >> 2:
                        del arcs[next(iter(arcs))]
                    fits = arcs[key] = self._arc(last[start], t)
                if fits:
                    break
            else:
                raise ValueError(f"no path spells {word[:80]!r}")
            last.append(t)
        ids, j = array("i"), n - 1
        while j >= 0:
            ids.append(last[j])
            j -= lengths[last[j]]
        ids.reverse()
        return ids.tobytes()

    def _lockstep(self, words: list[bytes]) -> list[bytes]:
        data = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        size = np.array([len(w) for w in words], np.int64)
        begin = np.cumsum(size) - size
        nth = np.arange(len(data)) - np.repeat(begin, size)  # place in the word, from 0
        final = np.zeros(len(data), bool)
        final[begin + size - 1] = True
        # labels that end at each place, by walking back from it
        where, node = np.arange(len(data)), np.zeros(len(data), np.int64)
        if self.end:
            node[final] = self._step(np.zeros(1, np.int64), self.END)
        place, token = [], []
        for back in range(int(self.lengths.max())):
            inside = (nth[where] >= back) & (node >= 0)
            where, node = where[inside], node[inside]
            if not len(where):
                break
            node = self._step(node, data[where - back])
            label = np.where(node >= 0, self.tokens[node], -1)
            place.append(where[label >= 0])
            token.append(label[label >= 0])
        place, token = (np.concatenate(x[::-1]) if x else np.zeros(0, np.int64) for x in (place, token))  # the longest first
        order = np.lexsort((place, nth[place]))  # stable: by place in the word, then word
        place, token = place[order], token[order]
        before = place - self.lengths[token]
        start = nth[place] - self.lengths[token] < 0
        first = np.flatnonzero(np.append(True, place[1:] != place[:-1])) if len(place) else np.zeros(0, np.int64)
        if len(first) != len(data):
            raise ValueError("a word has a byte that the vocabulary lacks")
        behind = np.append(first[1:], len(place))
        step = nth[place[first]]
        edges = np.searchsorted(step, np.arange(int(step[-1]) + 2)) if len(step) else [0]
        last = np.full(len(data), -1, np.int64)  # the token that ends each prefix
        for lo, hi in zip(edges[:-1], edges[1:]):
            at, end = first[lo:hi], behind[lo:hi]
            while len(at):
                fits = start[at]
                rest = np.flatnonzero(~fits)
                previous = last[before[at[rest]]]
                reached = previous >= 0
                fits[rest[reached]] = self.allows(previous[reached], token[at[rest[reached]]])
                last[place[at[fits]]] = token[at[fits]]
                at, end = at[~fits] + 1, end[~fits]
                at, end = at[at < end], end[at < end]
        # back along the path of every whole word
        here, alive = begin + size - 1, np.arange(len(words))
        ids, owner = [], []
        while len(alive):
            t = last[here]
            if (t < 0).any():
                raise ValueError(f"no path spells {words[int(alive[t < 0][0])][:80]!r}")
            ids.append(t)
            owner.append(alive)
            here = here - self.lengths[t]
            more = here >= begin[alive]
            here, alive = here[more], alive[more]
        ids, owner = (np.concatenate(x[::-1]) for x in (ids, owner))
        by_word = np.argsort(owner, kind="stable")
        flat = ids[by_word].astype(np.int32).tobytes()
        upto = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(words)))]) * 4
        return [flat[a:b] for a, b in zip(upto[:-1].tolist(), upto[1:].tolist())]


class Tokenizer:
    """What a tokenizer file of this kind says (lower case, word ends marked,
    white space dropped, byte letters), with the automaton of its merges.
    Made from plain tables, which ``compiled`` takes from the file's text."""

    def __init__(self, tables: dict):
        self.automaton = Automaton(*tables["automaton"], letters=byte_letters()).ready()
        self.special, self.labels = tables["special"], tables["labels"]
        self.marks = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.pattern = regex.compile(tables["pattern"])
        self.memory, self.limit = {}, REMEMBERED
        self.separators = re.compile("[\x1c-\x1f]")
        self.spaces = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")

    @staticmethod
    def compiled(text: str) -> dict:
        spec = json.loads(text)
        model = spec["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        automaton = Automaton.compiled(model["vocab"], merges, model["end_of_word_suffix"], byte_letters())
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        own = {s: i for s, i in automaton.vocab.items() if s not in special}
        return {
            "automaton": (own, automaton.end, automaton.parts, automaton.made, automaton.merge_of), "special": special,
            "labels": {i: s for s, i in [*model["vocab"].items(), *special.items()]},
            "pattern": next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"),
        }

    def _words(self, text: str) -> list[str]:
        """The lower-cased words between white space."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
        spaced = self.spaces.split(text) if self.separators.search(text) else None
        if text.isascii():
            return text.lower().split() if spaced is None else [w.lower() for w in spaced if w]
        # one character at a time, as a final sigma is no case of its own here
        lower = lambda t: t.replace("\u03a3", "\u03c3").lower()
        return lower(" ".join(text.split())).split(" ") if spaced is None else [lower(w) for w in spaced if w]

    def _learn(self, words: set[str]) -> dict[str, bytes]:
        """Encodings of new words: their pieces are read together, each once."""
        plain, pieces = [], {}
        for w in words:
            if w.isascii() and w.isalpha():
                plain.append(w)
            else:
                pieces[w] = self.pattern.findall(w)
        new = list({*plain, *(p for found in pieces.values() for p in found if p)})
        ids = dict(zip(new, self.automaton.encode([p.encode() for p in new])))
        for w, found in pieces.items():
            ids[w] = b"".join([ids[p] for p in found if p]) if len(found) != 1 or found[0] != w else ids[w]
        return {w: ids[w] for w in words}

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids (32 bits each) of texts; null is the empty text."""
        out, lo = [], 0
        while lo < len(texts):
            hi, size = lo, 0
            while hi < len(texts) and (hi == lo or size + len(texts[hi] or "") <= TOGETHER):
                size += len(texts[hi] or "")
                hi += 1
            out += self._encode(texts[lo:hi])
            lo = hi
        return out

    def _encode(self, texts: list[str | None]) -> list[bytes]:
        parts = []
        for text in texts:
            text = text or ""
            parts.append(self.marks.split(text) if self.marks and "<" in text else [text])
        words = [[self._words(part) if i % 2 == 0 else part for i, part in enumerate(found)] for found in parts]
        known = self.memory
        if len(known) > self.limit:  # the older half goes
            for old in list(islice(known, len(known) // 2)):
                del known[old]
        new = set()
        for found in words:
            for part in found[::2]:
                new.update(part)
        fresh = self._learn(new.difference(known))
        known.update(fresh)
        get = known.__getitem__
        out = [b"".join([b"".join(map(get, part)) if i % 2 == 0 else array("i", [self.special[part]]).tobytes() for i, part in enumerate(found)]) for found in words]
        for word in fresh:
            if len(word) > 64:
                del known[word]
        return out


def of_worker(tables: dict) -> Tokenizer:
    """The tokenizer of broadcast tables, which a Python worker keeps, with
    its memory, from task to task."""
    if "tokenizer" not in tables:
        tables["tokenizer"] = Tokenizer(tables)
    return tables["tokenizer"]


def load(path: str) -> dict:
    """The compiled tables of a tokenizer file, made once on the driver (their
    size is the vocabulary's)."""
    with open(path, encoding="utf-8") as file:
        return Tokenizer.compiled(file.read())


def _and(docs: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([*docs.schema.fields, T.StructField(name, kind)])


def encode(docs: DataFrame, tokenizer: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` with ``ids_col``, array<int>: the token ids of every whole text.

    tokenizer: path of a tokenizer file, readable by the driver.  A null text
    counts as empty and has no ids.  Special tokens standing in a text are
    taken as such.  Other columns are carried along, whatever their names (a
    column already called ``ids_col`` is replaced); repeated rows and empty
    tables are nothing special.
    """
    held = docs.sparkSession.sparkContext.broadcast(load(tokenizer))
    docs = docs.drop(ids_col)
    names, place = docs.columns, docs.columns.index(text_col)

    def run(batches):
        spec = of_worker(held.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                found = spec.encode(part.column(place).to_pylist())
                off = np.cumsum([0, *(len(x) // 4 for x in found)], dtype=np.int32)
                ids = pa.ListArray.from_arrays(pa.array(off), pa.array(np.frombuffer(b"".join(found), np.int32)))
                yield pa.RecordBatch.from_arrays([*part.columns, ids], names=[*names, ids_col])

    return docs.mapInArrow(run, _and(docs, ids_col, T.ArrayType(T.IntegerType())))


def decode(docs: DataFrame, tokenizer: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``docs`` with ``text_col``: the arc labels of the ids, joined by a blank
    as a tokenizer without a decoder does; null ids give the empty text.

    The labels are one constant array of the query, so decoding is a lookup
    in the JVM and needs no Python worker.
    """
    labels = load(tokenizer)["labels"]
    # no label holds a line break: labels are made of visible characters
    known = F.split(F.lit("\n".join(labels.get(i, "") for i in range(max(labels) + 1))), "\n")
    text = F.array_join(F.transform(F.col(ids_col), lambda i: F.get(known, i)), " ")
    return docs.withColumn(text_col, F.coalesce(text, F.lit("")))


def digests(docs: DataFrame, tokenizer: str, keep_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, and the digests of ids and decoded text (and the ids);
    one row per input row, null ids and repeated rows as they are.  Null and
    empty texts have no tokens and the digests of the empty text."""
    ids = encode(docs.select("doc_id", "text"), tokenizer).select(
        "doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"))
    return decode(ids, tokenizer).select("doc_id", "n_tokens", *(["ids"] if keep_ids else []), "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))
