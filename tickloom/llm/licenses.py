"""License notices by diagonal voting.

Every text gives all its rolling word k-grams as rows, which Spark joins by hash with the places of the templates'
k-grams. A match of text word ``at`` with template word ``place`` votes for the diagonal ``at - place``: a notice that was
copied word for word puts all its votes on one diagonal, one with words put in or left out on a few neighbouring ones. Votes are
counted by (document, template, diagonal), neighbouring diagonals merge into spans, and spans with enough votes
are compared word by word with the template. Phrases are short templates whose diagonals never merge and
must match in full.

A gram is joined wherever it stands, so a text of any length is read whole; only hits are shuffled, by document.
"""

from __future__ import annotations

import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm import textkit
from tickloom.llm.common import hash_map, in_map, stored

#: Words of a gram of a phrase, and of a longer notice.
PHRASE_GRAM, NOTICE_GRAM = 2, 4
#: Diagonals at most so far apart belong to one span: so many words may be put in or left out at a place.
BAND = 6
#: Templates of more words than this are joined without a broadcast.
BROADCAST_WORDS = 100_000

# Phrases with their labels, and the wording of public license notices.
PHRASES = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]
NOTICES = [
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        "(the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that "
        "the above copyright notice and this permission notice appear in all copies",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
        "are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    ),
    (
        "apache",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the "
        "License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
    ),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
        "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    ),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file"),
    ("boost", "Distributed under the Boost Software License, Version 1.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("cc", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc", "Licensed under CC BY 4.0"),
    ("cc", "Licensed under CC BY-SA 4.0"),
    ("cc", "Licensed under CC BY-NC 4.0"),
]
#: A span carries its template's label if so many tenths of the words agree, of the longer of template and span.
AGREE = 8

_FOLD = bytes.maketrans(bytes(range(0x41, 0x5B)), bytes(range(0x61, 0x7B)))
_WORDS = re.compile(rb"[0-9a-z\x80-\xff]+")


def words_of(text: str | None) -> list[bytes]:
    return _WORDS.findall((text or "").encode().translate(_FOLD))


class Template(NamedTuple):
    label: str
    words: list[bytes]
    phrase: bool

    @property
    def gram(self) -> int:
        return PHRASE_GRAM if self.phrase else NOTICE_GRAM

    @property
    def n_grams(self) -> int:
        return len(self.words) - self.gram + 1

    @property
    def band(self) -> int:
        return 0 if self.phrase else BAND

    @property
    def needed(self) -> int:
        """Votes of a span that is looked at: all of a phrase, three tenths of a notice."""
        return self.n_grams if self.phrase else max(1, 3 * self.n_grams // 10)


def templates_of(phrases=PHRASES, notices=NOTICES) -> list[Template]:
    """Templates from (phrase, label) and (label, notice) pairs; each must have a gram's words at least."""
    found = [Template(label, words_of(text), True) for text, label in phrases]
    found += [Template(label, words_of(text), False) for label, text in notices]
    if short := [t for t in found if t.n_grams < 1]:
        raise ValueError(f"too few words for a gram: {short[0]}")
    return found


def rolling(words: textkit.Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(index of the first word, hash) of each run of ``k`` words inside one row."""
    n = len(words) - k + 1
    if n < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    sums = np.full(n, k, np.uint64)
    for j in range(k):
        sums = sums * np.uint64(0x9E3779B97F4A7C15) + words.hashes[j : n + j]
    row = words.rows()
    at = np.flatnonzero(row[:n] == row[k - 1 :])
    return at, textkit.mix(sums[at]).view(np.int64)


def _template_grams(spark, templates: list[Template]) -> DataFrame:
    rows = []
    for number, t in enumerate(templates):
        words = textkit.Words(pa.array([b" ".join(t.words)]), textkit.ALNUM)
        places, hashes = rolling(words, t.gram)
        rows += [(h, number, p, t.gram, t.band, t.needed) for p, h in zip(places.tolist(), hashes.tolist())]
    table = spark.createDataFrame(rows, "gram long, template int, place int, size int, band int, needed int")
    return F.broadcast(table) if sum(len(t.words) for t in templates) <= BROADCAST_WORDS else table


def _grams(rows: DataFrame, sizes: list[int]) -> DataFrame:
    """key, at, gram: all rolling grams of all texts."""

    def cut(batches):
        for batch in batches:
            for part in textkit.slices(batch, "text", textkit.SLICE):
                words = textkit.Words(part.column("text"), textkit.ALNUM)
                row, key = words.rows(), part.column("key").to_numpy()
                for k in sizes:
                    at, gram = rolling(words, k)
                    place = at - words.first[row[at]]
                    yield pa.RecordBatch.from_arrays([pa.array(key[row[at]]), pa.array(place), pa.array(gram)], ["key", "at", "gram"])

    return rows.select("key", "text").mapInArrow(cut, "key long, at long, gram long")


class _Count(textkit.Words):
    """Words that are only counted."""

    def _hash(self, data):
        return np.zeros(0, np.uint64)


def _with_text_of(rows: DataFrame, wanted) -> DataFrame:
    """key, doc_id, n_words, text; the text only of rows whose key may be wanted."""

    def count(batches):
        for batch in batches:
            for part in textkit.slices(batch, "text"):
                n = np.diff(_Count(part.column("text"), textkit.ALNUM).first)
                rest = ~in_map(wanted.value, part.column("key").to_numpy())
                text = part.column("text").take(pa.array(np.arange(part.num_rows), mask=rest))
                yield pa.RecordBatch.from_arrays([part.column("key"), part.column("doc_id"), pa.array(n), text], ["key", "doc_id", "n_words", "text"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(count, f"key long, doc_id {kind}, n_words long, text string")


SPAN = "struct<template:int,label:string,phrase:boolean,start:long,end:long,matched:long,size:long>"


def matched_words(words: list[bytes], template: list[bytes], start: int, end: int, diagonals: list[int]) -> int:
    """Template words that stand in words[start:end] on one of the diagonals."""
    n = 0
    for place, word in enumerate(template):
        n += any(start <= place + d < end and words[place + d] == word for d in diagonals)
    return n


def license_spans(docs: DataFrame, templates: list[Template] | None = None, text: str = "text") -> DataFrame:
    """doc_id, n_words and the verified ``spans`` of templates for each row, ordered by (template, start).

    A span has the template's number, its label, whether it is a phrase, the words ``start`` to ``end`` (from 0, end excluded), the
    template words ``matched`` there, and ``size``, the longer of span and template. Phrases that match in part are left out.

    Null and empty texts have no words and no spans. Repeated rows get equal results each. Ties don't arise: every
    span that has the votes is reported. Rows are told apart by a hash of doc_id and text, so doc_id may be null or repeat; other columns are
    not read, whatever their names. Texts are read whole, in pieces of bounded size if there are many, a very long one at once.
    """
    templates = templates_of() if templates is None else templates
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.col(text).alias("text")).withColumn("key", F.xxhash64("doc_id", "text"))
    grams = _template_grams(spark, templates)
    hits = _grams(rows, sorted({t.gram for t in templates})).join(grams, "gram")
    votes = hits.groupBy("key", "template", (F.col("at") - F.col("place")).alias("diagonal")).agg(
        F.count_distinct("at").alias("votes"), F.min("at").alias("start"), F.max(F.col("at") + F.col("size")).alias("end"),
        F.first("band").alias("band"), F.first("needed").alias("needed"),
    )
    along = Window.partitionBy("key", "template").orderBy("diagonal")
    apart = F.coalesce((F.col("diagonal") - F.lag("diagonal").over(along) > F.col("band")).cast("int"), F.lit(0))
    runs = votes.withColumn("apart", apart).withColumn("run", F.sum("apart").over(along))
    spans = runs.groupBy("key", "template", "run").agg(
        F.sum("votes").alias("votes"), F.min("start").alias("start"), F.max("end").alias("end"),
        F.collect_list("diagonal").alias("diagonals"), F.first("needed").alias("needed"),
    )
    voted = spans.filter("votes >= needed").groupBy("key").agg(F.collect_list(F.struct("template", "start", "end", "diagonals")).alias("voted"))
    voted = stored(voted, "license-spans")
    seen = _with_text_of(rows, hash_map(voted, "key")).join(voted, "key", "left").select("doc_id", "n_words", "text", "voted")

    def verify(batches):
        kind = pa.list_(pa.struct([("template", pa.int32()), ("label", pa.string()), ("phrase", pa.bool_()), ("start", pa.int64()),
                                   ("end", pa.int64()), ("matched", pa.int64()), ("size", pa.int64())]))
        for batch in batches:
            out = []
            for at, found in enumerate(batch.column("voted").to_pylist()):
                verified = []
                if found:
                    words = words_of(batch.column("text")[at].as_py())
                    for span in sorted(found, key=lambda s: (s["template"], s["start"])):
                        t, start, end = templates[span["template"]], span["start"], span["end"]
                        matched = matched_words(words, t.words, start, end, span["diagonals"])
                        if matched == len(t.words) or not t.phrase:
                            verified.append((span["template"], t.label, t.phrase, start, end, matched, max(len(t.words), end - start)))
                out.append([dict(zip(("template", "label", "phrase", "start", "end", "matched", "size"), v)) for v in verified])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_words"), pa.array(out, kind)], ["doc_id", "n_words", "spans"])

    doc_id = seen.schema["doc_id"].dataType.simpleString()
    return seen.mapInArrow(verify, f"doc_id {doc_id}, n_words long, spans array<{SPAN}>")


def agrees(span: Column) -> Column:
    """Whether a span carries its template's label."""
    return F.when(span["phrase"], span["matched"] == span["size"]).otherwise(10 * span["matched"] >= AGREE * span["size"])


def license_labels(docs: DataFrame, templates: list[Template] | None = None, text: str = "text") -> DataFrame:
    """Labels and scores of each document, from ``license_spans``, whose rules for odd rows hold here too.

    doc_id, n_words, n_base (places of phrases), first_word and last_word (their least and greatest start, else null), base_labels
    and labels (of phrases; of phrases and agreeing notices: distinct, sorted, joined by commas), score (the greatest share of
    agreeing words of any span, 0 without spans), n_spans (agreeing notices and phrases).
    """
    found = license_spans(docs, templates, text)
    base = F.filter("spans", lambda s: s["phrase"])
    good = F.filter("spans", agrees)
    labels = lambda spans: F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")
    starts = F.transform(base, lambda s: s["start"])
    share = F.array_max(F.transform("spans", lambda s: s["matched"].cast("double") / s["size"].cast("double")))
    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        labels(base).alias("base_labels"), labels(good).alias("labels"), F.coalesce(share, F.lit(0.0)).alias("score"),
        F.size(good).cast("long").alias("n_spans"),
    )
