import hashlib
import random
import sys
from array import array

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer as Library

from forkcast.llm import bpe_automaton
from forkcast.llm.bpe_automaton import Automaton, Tokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    t = Library.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


@pytest.fixture(scope="module")
def own():
    return Tokenizer(bpe_automaton.load(PATH))


def test_every_merge_of_the_file_has_a_state(own):
    assert own.automaton.states == 48_894 + 1


def plain_bpe(symbols, merges):
    """Merges one by one, the earliest first, from the left."""
    rank = {m: i for i, m in enumerate(merges)}
    while True:
        pairs = [rank[p] for p in zip(symbols, symbols[1:]) if p in rank]
        if not pairs:
            return symbols
        a, b = merges[min(pairs)]
        out, i = [], 0
        while i < len(symbols):
            if symbols[i:i + 2] == [a, b]:
                out.append(a + b)
                i += 2
            else:
                out.append(symbols[i])
                i += 1
        symbols = out


def test_automaton_on_random_merges():
    rng = random.Random(1)
    for _ in range(150):
        tokens, merges = ["a", "b", "c"], []
        for _ in range(rng.randrange(1, 25)):
            a, b = rng.choice(tokens), rng.choice(tokens)
            if a + b not in tokens:
                tokens.append(a + b)
                merges.append((a, b))
        automaton = Automaton.compiled({t: i for i, t in enumerate(tokens)}, merges)
        assert automaton.states <= len(merges) + 1
        words = [[rng.choice("abc" if rng.random() < 0.7 else "a") for _ in range(rng.randrange(1, 14))] for _ in range(60)] + [["a"] * 200]
        for word, ids in zip(words, automaton.encode(["".join(w).encode() for w in words])):
            assert [tokens[i] for i in array("i", ids)] == plain_bpe(word, merges), (merges, word)
        # the table says what the gadgets say, also when its entries are replaced
        some = np.array([[i, j] for i in range(len(tokens)) for j in range(len(tokens)) if tokens[i] in automaton.vocab and tokens[j] in automaton.vocab])
        automaton.known_arcs[:] = rng.randrange(1 << 40)
        for _ in range(2):
            assert automaton.allows(some[:, 0], some[:, 1]).tolist() == [automaton._arc(i, j) for i, j in some.tolist()]


def same(own, library, texts):
    own.memory, own.limit = {}, 1000
    for text, ids, want in zip(texts, own.encode(texts), library.encode_batch(texts, add_special_tokens=False)):
        got = array("i", ids).tolist()
        assert got == want.ids, text[:200]
        assert " ".join(map(own.labels.__getitem__, got)) == library.decode(want.ids, skip_special_tokens=False)


def test_documents_like_the_library(own, library):
    texts = [t for t, in duckdb.sql("select text from '/root/testdata/sf0.01/documents.parquet'").fetchall()]
    same(own, library, texts)


def test_odd_texts_like_the_library(own, library):
    rng = random.Random(2)
    odd = ["", " ", "don't we'LL I'm it'S 'tis", "<|endoftext|>a<|startoftext|> <|ENDOFTEXT|><|endoftext|", "ΑΣ Σ ΣΑ İI ǅ ﬁ ẞ K", "é 각 Å",
           "a\x1cb\x1d \x85c\xa0d e　f​g h", "½ ² Ⅷ 1234 ๒ 一二", "👍🏽👩‍👩‍👧 ❤️", "x" * 5000, "\x00\x01\x7f", "日本語 テキスト かな 한국어 العربية עברית हिन्दी"]
    letters = ["a", "B", "é", "Σ", "'", "s", "9", " ", "\n", "<|endoftext|>", "!", "你", "́", "ll", "ß"]
    odd += ["".join(rng.choice(letters) for _ in range(rng.randrange(30))) for _ in range(3000)]
    same(own, library, odd)


def test_every_character_like_the_library(own, library):
    """Characters newer than either side's tables may be classed differently; none older is."""
    import unicodedata
    chars = [chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000 and unicodedata.category(chr(c)) != "Cn"]
    texts = [f"a{c}1{c}{c} " for c in chars]
    wrong = [c for c, ids, want in zip(chars, own.encode(texts), library.encode_batch(texts, add_special_tokens=False)) if array("i", ids).tolist() != want.ids]
    assert wrong == [], (len(wrong), [hex(ord(c)) for c in wrong[:50]])


def test_rows(spark, library):
    rows = [(1, "Hello there", "x", 7), (1, "Hello there", "x", 7), (None, None, None, None), (3, "", "y", 8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string, decoded int")
    out = bpe_automaton.decode(bpe_automaton.encode(df, PATH), PATH).collect()
    ids = library.encode("Hello there", add_special_tokens=False).ids
    assert sorted(((r.doc_id or 0), r.ids, r.decoded) for r in out) == [(0, [], ""), (1, ids, "hello</w> there</w>"), (1, ids, "hello</w> there</w>"), (3, [], "")]
    got = {r.doc_id: r for r in bpe_automaton.digests(df, PATH).collect()}
    assert got[1].n_tokens == 2 and got[1].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
    assert got[3].n_tokens == 0 and got[3].decoded_sha256 == hashlib.sha256(b"").hexdigest() == got[None].ids_sha256
    assert bpe_automaton.digests(df.limit(0), PATH).collect() == []
