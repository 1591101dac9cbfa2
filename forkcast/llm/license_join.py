"""License scans by an exact set-similarity join.

A text block is a window of consecutive words, a quarter longer than a license
template, over any line breaks; so a notice may be wrapped, and words strewn
over a long line are none.  Every block is found that contains ``threshold`` or
more of a template's words, |block & template| >= threshold * |template| over
sets of words, and all of its marks: the words that tell it from its siblings
(``mit``, ``lesser``, ``nc``, the version).  Words are ordered by how many
documents have them, rarest first, over the whole table.  Then

- prefix filter: a text that meets a template has one of the template's
  first |template| - needed + 1 words; an inverted index holds only those;
- length filter: a text with fewer template words than needed cannot meet it;
- positional filter: a common word at places i and j leaves at most
  min(i, j) + 1 + min(words behind i, words behind j) common words;
- what is left is verified by intersecting the sets of its windows.

Of windows that start within a template's length of one another, one stays.  The
template side is a fixed list of short notices, so its index is part of the
query, texts are never shuffled, and a block of a hot source costs no more
than any other.  Only built-in functions run; a document's windows are looked
at only if the whole of its words meets a template, and their number is that
of its template words.
"""

from __future__ import annotations

import math
import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters between words (of lower-cased text).
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


class Template(NamedTuple):
    label: str
    text: str
    marks: str


#: Short notices of public licenses, and the words that tell each from its siblings.
TEMPLATES = (
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files", "permission granted"),
    Template("mit", "Released under the MIT License", "mit"),
    Template("apache-2", "Licensed under the Apache License, Version 2.0", "apache 2"),
    Template("gpl-3", "This work is licensed under the GNU General Public License, version 3", "gnu 3"),
    Template("gpl-2", "This program is free software; you can redistribute it under the terms of the GNU General Public License, version 2", "gnu 2"),
    Template("lgpl-3", "Licensed under the GNU Lesser General Public License, version 3", "gnu lesser 3"),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", "redistribution"),
    Template("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "mozilla 2"),
    Template("cc-by-nc", "Licensed under CC BY-NC 4.0", "cc nc"),
    Template("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License", "commons noncommercial"),
    Template("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License", "commons sharealike"),
)


class Phrase(NamedTuple):
    label: str
    words: str


PHRASES = (Phrase("mit", "under the mit license"), Phrase("apache-2", "apache license version 2"), Phrase("cc-by-nc", "cc by nc"))


def _words(template: Template) -> list[str]:
    return sorted(set(filter(None, re.split(BETWEEN, template.text.lower()))))


def _length(template: Template) -> int:
    return len(list(filter(None, re.split(BETWEEN, template.text.lower()))))


def _width(template: Template) -> int:
    """Words in a row that a notice may take."""
    return _length(template) + _length(template) // 4


def _low(text: Column) -> Column:
    """Lower case; the Kelvin sign, the one other character whose lower case
    is an ASCII letter, is kept out of the words."""
    return F.lower(F.replace(F.coalesce(text.cast("string"), F.lit("")), F.lit("\u212a"), F.lit("\u00e5")))


def _spaced(low: Column) -> Column:
    """The words of a text with a blank before, between and behind."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(low, BETWEEN, " ")), F.lit(" "))


def _blanks(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def phrase_places(spaced: Column, phrase: Phrase) -> Column:
    """(n, first, last): the places of a phrase, by the word it starts at; null if it has none."""
    inside = F.lit(f" {phrase.words} ")
    n = F.regexp_count(spaced, F.lit(f"(?<= ){re.escape(phrase.words)}(?= )"))
    first = _blanks(F.substring(spaced, F.lit(1), F.locate(f" {phrase.words} ", spaced))) - 1
    behind = F.locate(f" {phrase.words} "[::-1], F.reverse(spaced))
    last = _blanks(F.substring(spaced, F.lit(1), F.length(spaced) - behind - F.length(inside) + 2)) - 1
    return F.when(F.contains(spaced, inside), F.struct(n.cast("long").alias("n"), first.cast("long").alias("first"), last.cast("long").alias("last")))


def word_order(docs: DataFrame, vocabulary: list[str], text_col: str = "text") -> list[str]:
    """The vocabulary, rarest word first: by documents that have it (ties by name).

    One row a word reaches the driver."""
    words = F.array_intersect(F.split(_spaced(_low(F.col(text_col))), " "), F.lit(vocabulary))
    counts = {r.word: r.n for r in docs.select(F.explode(words).alias("word")).groupBy("word").agg(F.count("*").alias("n")).collect()}
    return sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))


def _literal(value) -> Column:
    return F.array(*map(_literal, value)) if isinstance(value, list) else F.lit(value)


def _let(value: Column, body) -> Column:
    """body(value), with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def matching_blocks(spaced: Column, templates: tuple[Template, ...], order: list[str], threshold: float) -> Column:
    """array<struct<word, label, containment>>: the windows of a text that meet
    a template, by their first word (from 0)."""
    rank = {w: i for i, w in enumerate(order)}
    sets = [sorted(rank[w] for w in _words(t)) for t in templates]
    needed = [math.ceil(threshold * len(s) - 1e-9) for s in sets]
    index: dict[int, list[tuple[int, int]]] = {}
    for k, (s, need) in enumerate(zip(sets, needed)):
        for i, r in enumerate(s[:len(s) - need + 1]):
            index.setdefault(r, []).append((k, i))
    ranks = F.create_map(*(F.lit(x) for w, i in rank.items() for x in (w, i)))
    entry = lambda k, i: F.struct(F.lit(k).alias("k"), F.lit(i).alias("i"), F.lit(len(sets[k])).alias("size"), F.lit(needed[k]).alias("need"))
    postings = F.create_map(*(x for r, found in index.items() for x in (F.lit(r), F.array(*(entry(k, i) for k, i in found)))))
    members, marks = (F.array(*(_literal(s) for s in x)) for x in (sets, [[rank[w] for w in t.marks.split()] for t in templates]))
    widths, lengths = (F.array(*(F.lit(f(t)) for t in templates)) for f in (_width, _length))
    labels = F.array(*(F.lit(t.label) for t in templates))

    def candidates(block: Column) -> Column:
        def at(r: Column, j: Column) -> Column:
            room = lambda e: F.least(e["i"], j) + 1 + F.least(e["size"] - e["i"] - 1, F.size(block) - j - 1)
            return F.filter(F.coalesce(postings[r], F.slice(postings[next(iter(index))], 1, 0)), lambda e: (F.size(block) >= e["need"]) & (room(e) >= e["need"]))
        return F.array_distinct(F.transform(F.flatten(F.transform(block, at)), lambda e: F.struct(e["k"].alias("k"), e["need"].alias("need"))))

    whole = F.array_sort(F.transform(F.array_intersect(F.split(spaced, " "), F.lit(order)), lambda w: ranks[w]))
    common = lambda words, c: F.array_intersect(words, F.get(members, c["k"]))
    marked = lambda words, c: F.size(F.array_except(F.get(marks, c["k"]), words)) == 0

    def placed() -> Column:
        """The words of any template, with their places."""
        words = F.filter(F.split(spaced, " "), lambda w: w != "")
        return F.filter(F.transform(words, lambda w, i: F.struct(ranks[w].alias("r"), i.alias("at"))), lambda x: x["r"].isNotNull())

    def windows(placed: Column, c: Column) -> Column:
        """The windows that meet template c, by the template's word that each starts with."""
        width = F.get(widths, c["k"])

        def window(own: Column) -> Column:
            def started(x: Column, i: Column) -> Column:
                inside = F.array_distinct(F.transform(F.filter(F.slice(own, i + 1, width), lambda y: y["at"] < x["at"] + width), lambda y: y["r"]))
                return _let(inside, lambda words: F.struct(x["at"].alias("at"), F.when(marked(words, c), F.size(words)).otherwise(0).alias("n")))
            return F.filter(F.transform(own, started), lambda x: x["n"] >= c["need"])
        return _let(F.filter(placed, lambda x: F.array_contains(F.get(members, c["k"]), x["r"])), window)

    def best(found: Column, c: Column) -> Column:
        """From the left: of windows that start within a template's length of one another, the first of the best."""
        def step(state: Column, x: Column) -> Column:
            open_ = state["open"]
            closes = open_.isNotNull() & (x["at"] - open_["at"] >= F.get(lengths, c["k"]))
            kept = F.when(closes, F.concat(state["kept"], F.array(open_))).otherwise(state["kept"])
            return F.struct(kept.alias("kept"), F.when(open_.isNull() | closes | (x["n"] > open_["n"]), x).otherwise(open_).alias("open"))
        start = F.struct(F.array().cast("array<struct<at:int,n:int>>").alias("kept"), F.lit(None).cast("struct<at:int,n:int>").alias("open"))
        kept = F.aggregate(found, start, step, lambda state: F.when(state["open"].isNull(), state["kept"]).otherwise(F.concat(state["kept"], F.array(state["open"]))))
        return F.transform(kept, lambda x: F.struct(x["at"].cast("long").alias("word"), F.get(labels, c["k"]).alias("label"), (x["n"] / F.size(F.get(members, c["k"]))).alias("containment")))

    none = F.array().cast("array<struct<word:bigint,label:string,containment:double>>")
    met = _let(whole, lambda block: F.filter(candidates(block), lambda c: (F.size(common(block, c)) >= c["need"]) & marked(block, c)))
    each = lambda p, ks: F.flatten(F.transform(ks, lambda c: _let(windows(p, c), lambda found: best(found, c))))
    starts = "|".join(re.escape(order[r]) for r in sorted(index))
    found = _let(met, lambda ks: F.when(F.size(ks) > 0, _let(placed(), lambda p: F.array_sort(each(p, ks)))).otherwise(none))
    return F.when(F.regexp_like(spaced, F.lit(f" (?:{starts}) ")), found).otherwise(none)


def scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, phrases: tuple[Phrase, ...] = PHRASES, threshold: float = 0.8,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, places (label, n, first, last of each phrase that the
    text has), blocks (word, label, containment of each window that meets a
    template, by its first word); one row per input row.

    Words are runs of ASCII letters (A-Z lower-cased), digits and characters
    above 0x7F, counted from 0.  Null and empty
    texts have no words, places or blocks.  Null ids and repeated rows are
    carried through, other columns ignored; an empty table gives an empty
    result.
    """
    order = word_order(docs, sorted(set().union(*map(_words, templates))), text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), _spaced(_low(F.col(text_col))).alias("spaced"))
    spaced = F.col("spaced")
    places = [F.struct(F.lit(p.label).alias("label"), phrase_places(spaced, p).alias("at")) for p in phrases]
    return rows.select(
        "doc_id", F.when(F.length(spaced) > 2, _blanks(spaced) - 1).otherwise(0).cast("long").alias("n_words"),
        F.filter(F.array(*places), lambda p: p["at"].isNotNull()).alias("places"),
        matching_blocks(spaced, templates, order, threshold).alias("blocks"))


def digests(found: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    score: 1 with a phrase, else the highest containment of a window, else 0."""
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    base = F.transform("places", lambda p: p["label"])
    return found.select(
        "doc_id", "n_words", F.aggregate("places", F.lit(0).cast("long"), lambda n, p: n + p["at"]["n"]).alias("n_base"),
        F.array_min(F.transform("places", lambda p: p["at"]["first"])).alias("first_word"), F.array_max(F.transform("places", lambda p: p["at"]["last"])).alias("last_word"),
        joined(base).alias("base_labels"), joined(F.concat(base, F.transform("blocks", lambda b: b["label"]))).alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce(F.array_max(F.transform("blocks", lambda b: b["containment"])), F.lit(0.0))).alias("score"))
