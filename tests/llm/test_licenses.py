"""License scans against a brute-force version of the whole operator."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from tickloom.llm import licenses
from test_decontaminate import split


def brute(text, templates):
    """The digest columns of one text, with words and grams as strings."""
    words, spans = split(text), []
    for t in templates:
        target = [w.decode() for w in t.words]
        places = {}
        for p in range(t.n_grams):
            places.setdefault(tuple(target[p : p + t.gram]), []).append(p)
        votes = {}
        for at in range(len(words) - t.gram + 1):
            for p in places.get(tuple(words[at : at + t.gram]), ()):
                votes.setdefault(at - p, []).append(at)
        runs = []
        for d in sorted(votes):
            if runs and d - runs[-1][-1] <= t.band:
                runs[-1].append(d)
            else:
                runs.append([d])
        for run in runs:
            places = list(itertools.chain(*(votes[d] for d in run)))
            if len(places) < t.needed:
                continue
            start, end = min(places), max(places) + t.gram
            matched = len({p for p, d in itertools.product(range(len(target)), run) if start <= p + d < end and words[p + d] == target[p]})
            if matched == len(target) or not t.phrase:
                spans.append((t, start, matched, max(len(target), end - start)))
    base = [s for s in spans if s[0].phrase]
    good = [s for s in spans if s[0].phrase or 10 * s[2] >= 8 * s[3]]
    starts = [s[1] for s in base]
    names = lambda some: ",".join(sorted({s[0].label for s in some}))
    return (len(words), len(base), min(starts, default=None), max(starts, default=None), names(base), names(good),
            max((s[2] / s[3] for s in spans), default=0.0), len(good))


def texts():
    rng = random.Random(3)
    filler = ["the", "of", "software", "license", "copy", "é", "中x", "7", "without", "mit", "General", "PUBLIC"]
    notices = [text for _, text in licenses.NOTICES]
    out = [None, "", " .,; ", "MIT License", "mit-license, Mit\nLicense mit license", "license mit", "the Apache License; general public\tlicense.",
           "general public license general public license", "Licensed under CC BY-NC 4.0.", "licensed under cc by"]
    for k in range(60):
        words = " ".join(rng.choices(filler, k=rng.randint(0, 40)))
        notice = rng.choice(notices).split(" ")
        for _ in range(rng.choice([0, 0, 1, 3, 8])):  # words changed, put in or left out
            at = rng.randrange(len(notice))
            notice[at : at + rng.choice([0, 1, 1])] = rng.choice([["other"], [], ["very", "other"]])
        parts = [words, " ".join(notice), " ".join(rng.choices(filler, k=rng.randint(0, 9)))]
        out.append("\n".join(parts + parts[1:] * rng.choice([0, 0, 1])))
    return out


def test_against_brute_force(spark):
    docs = [(i if i % 7 else None, t, "x", 1) for i, t in enumerate(texts())]
    docs += docs[11:14]  # repeated rows
    frame = spark.createDataFrame(docs, "doc_id long, text string, label string, spans int").repartition(3)
    found = sorted(map(tuple, licenses.license_labels(frame).collect()), key=repr)
    templates = licenses.templates_of()
    assert found == sorted(((d, *brute(t, templates)) for d, t, *_ in docs), key=repr)
    assert {"mit", "isc", "bsd", "apache", "gpl", "cc"} <= {label for row in found for label in row[6].split(",")}


def test_very_long_text(spark):
    """A text longer than a piece, with a notice across its middle and phrases at both ends."""
    notice = licenses.NOTICES[2][1]
    text = "MIT License " + "word " * 260_000 + notice + " word" * 10 + " apache license"
    frame = spark.createDataFrame([(1, text), (2, "word"), (3, text)], "doc_id long, text string")
    rows = {r.doc_id: r for r in licenses.license_labels(frame).collect()}
    n = 2 + 260_000 + len(split(notice)) + 12
    assert (rows[1].n_words, rows[1].n_base, rows[1].first_word, rows[1].last_word) == (n, 2, 0, n - 2)
    assert rows[1].labels == "apache,bsd,mit" and rows[1].score == 1.0
    assert rows[3][1:] == rows[1][1:] and rows[2][1:] == (1, 0, None, None, "", "", 0.0, 0)


def test_own_templates_and_empty_table(spark):
    own = licenses.templates_of([("all rights reserved", "closed")], [("house", "do not copy this text without asking")])
    frame = spark.createDataFrame([("a", "All rights, reserved"), (None, "please do not copy this text without leave")], "doc_id string, text string")
    rows = {r.doc_id: (r.base_labels, r.labels) for r in licenses.license_labels(frame, own).collect()}
    assert rows == {"a": ("closed", "closed"), None: ("", "house")}
    assert licenses.license_labels(frame.filter(F.lit(False))).collect() == []
    with pytest.raises(ValueError):
        licenses.templates_of([("one", "x")], [])


def test_grams_are_joined_in_spark(spark):
    frame = spark.createDataFrame([(1, "mit license")], "doc_id long, text string")
    rows = frame.withColumn("key", F.xxhash64("doc_id", "text"))
    joined = licenses._grams(rows, [2, 4]).join(licenses._template_grams(spark, licenses.templates_of()), "gram")
    assert "BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()
