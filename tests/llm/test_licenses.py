import math
import re

import duckdb

from brute import lower
from forkcast.llm import license_join
from forkcast.llm.license_join import PHRASES, TEMPLATES

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def brute(text):
    text = lower(text)
    words = WORD.findall(text)
    places = {}
    for p in PHRASES:
        w = p.words.split()
        at = [i for i in range(len(words)) if words[i:i + len(w)] == w]
        if at:
            places[p.label] = (len(at), at[0], at[-1])
    blocks = {}
    for t in TEMPLATES:
        listed = WORD.findall(lower(t.text))
        want, width = set(listed), len(listed) + len(listed) // 4
        for i, w in enumerate(words):
            if w in want:
                inside = want & set(words[i:i + width])
                if len(inside) >= math.ceil(0.8 * len(want) - 1e-9) and set(t.marks.split()) <= inside:
                    blocks[t.label] = max(blocks.get(t.label, 0), round(len(inside) / len(want), 9))
    return len(words), places, blocks


TEXTS = ["", None, "under the MIT license", "x Under, the\nMIT-License! under the mit licenses, under the mit license.", "cc by nc cc by nc", "CC BY-NC 4.0", "apache license version 2 " * 3, "Apache License, Version 20",
         *(t.text for t in TEMPLATES), "a\n" + TEMPLATES[0].text.upper() + "\nmore\n" + TEMPLATES[2].text, "Licensed Apache License Version 2.0 the of und", "software is hereby granted free of charge to any person obtaining a copy and files documentation",
         "\u212a under the mit license", "été under the mit license", "l\u0130cense under the mit l\u0130cense", "w " * 60_000 + "under the mit license"]


def compare(rows, docs):
    for r in rows:
        n, places, blocks = brute(docs[r.doc_id])
        assert r.n_words == n, docs[r.doc_id]
        assert {p.label: (p.at.n, p.at.first, p.at.last) for p in r.places} == places
        most = {}
        for b in r.blocks:
            most[b.label] = max(most.get(b.label, 0), round(b.containment, 9))
        assert most == blocks, docs[r.doc_id]


def test_odd_texts(spark):
    docs = dict(enumerate(TEXTS))
    df = spark.createDataFrame([(i, t, "low", 2) for i, t in docs.items()], "doc_id long, text string, low string, blocks int")
    found = license_join.scan(df)
    compare(found.collect(), docs)
    for r in license_join.digests(found).collect():
        n, places, blocks = brute(docs[r.doc_id])
        assert r.n_base == sum(p[0] for p in places.values()) and r.base_labels == ",".join(sorted(places))
        assert (r.first_word, r.last_word) == ((min(p[1] for p in places.values()), max(p[2] for p in places.values())) if places else (None, None))
        assert r.labels == ",".join(sorted({*places, *blocks}))
        assert abs(r.score - (1 if places else max(blocks.values(), default=0))) < 1e-8
    assert license_join.digests(license_join.scan(df.limit(0))).collect() == []
    twice = spark.createDataFrame([(None, "cc by nc"), (None, "cc by nc")], "doc_id long, text string")
    assert [(r.doc_id, r.n_base) for r in license_join.digests(license_join.scan(twice)).collect()] == [(None, 1)] * 2


def test_whole_table(spark):
    path = "/root/testdata/sf0.01/documents.parquet"
    docs = dict(duckdb.sql(f"select doc_id, text from '{path}'").fetchall())
    rows = license_join.scan(spark.read.parquet(path)).collect()
    compare(rows, docs)
    assert len(rows) == len(docs) and any(r.blocks for r in rows)


def test_wrapped_notices(spark):
    mit, bsd, gpl = TEMPLATES[0].text, TEMPLATES[6].text, TEMPLATES[4].text.split()
    texts = [
        "Intro\n" + mit.replace("a copy of", "a copy\nof"), "Intro\n" + bsd.replace("forms, ", "forms,\n * "),
        "\n".join(gpl[i:i + 5] and " ".join(gpl[i:i + 5]) for i in range(0, len(gpl), 5)),
        mit.replace("a copy of", "a copy\nof") + "\nand so on\n" * 40 + bsd, mit + "\n" + bsd,
        " ".join(f"{w} " + "x " * 9 + "\n" for w in mit.split())]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: [(b.word, b.label, b.containment) for b in r.blocks] for r in license_join.scan(df).collect()}
    assert got[0] == [(1, "mit", 1.0)] and got[1] == [(1, "bsd", 1.0)] and got[2] == [(0, "gpl-2", 1.0)]
    assert got[3] == [(0, "mit", 1.0), (20 + 117, "bsd", 1.0)] and got[4] == [(0, "mit", 1.0), (20, "bsd", 1.0)] and got[5] == []
    assert {r.doc_id: r.score for r in license_join.digests(license_join.scan(df)).collect()}[0] == 1.0


def test_siblings_are_told_apart(spark):
    texts = ["Licensed under CC BY 4.0", "Licensed under CC BY-SA 4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License",
             "This work is licensed under the GNU General Public License, version 3", "We released the film under the old license", "Licensed under the GNU Lesser General Public License, version 3",
             "Licensed under CC BY-NC 4.0", "Released under the MIT License", "software " + "word " * 30 + "released the under license mit"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.labels for r in license_join.digests(license_join.scan(df)).collect()}
    assert [got[i] for i in range(len(texts))] == ["", "", "", "gpl-3", "", "lgpl-3", "cc-by-nc", "mit", "mit"]


def test_very_long_text_of_notices(spark):
    """Linear in the text: 200,000 words of wrapped notices, one after the other."""
    mit = TEMPLATES[0].text
    text = (mit.replace("a copy of", "a copy\nof") + "\n") * 10_000
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = license_join.scan(df).first()
    assert row.n_words == 200_000 and {b.label for b in row.blocks} == {"mit"} and [b.word for b in row.blocks][:3] == [0, 20, 40] and len(row.blocks) == 10_000
