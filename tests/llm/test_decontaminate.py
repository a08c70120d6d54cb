"""Decontamination against brute force."""

import random
import re

import pytest

from tickloom.llm import decontaminate


def split(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, items):
    windows = {}
    for name, text in items:
        w = split(text)
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add("null" if name is None else str(name))
    out = []
    for d, text in docs:
        w, hit, names = split(text), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if found := windows.get(tuple(w[i : i + n])):
                    hit.update(range(i, i + n))
                    names |= found
        out.append((str(d), len(w), len(hit), sorted(names)))
    return sorted(out)


@pytest.mark.parametrize("short, shard_words", [(False, 10**6), (True, 10**6), (True, 60)])
def test_against_brute_force(spark, short, shard_words):
    rng = random.Random(5)
    words = ["a", "b", "The", "x1", "é", "Z9", "中"]
    make = lambda n, k=7: rng.choice([" ", ", ", "\n"]).join(rng.choice(words[:k]) for _ in range(n))
    items = [(i, make(rng.randint(10, 30))) for i in range(12)] + [(40, None), (41, "?!"), (42, "a a a a a a a a a a a a"), (None, make(11)), (42, make(12))]
    if short:
        items += [(50, "x1 The é"), (51, "b b b"), (52, "The é"), (53, "Z9")]
    docs = [(i, make(rng.randint(0, 60))) for i in range(40)]
    docs += [(100 + k, f"{make(15)} {(t or '').upper()} {make(9)}") for k, (_, t) in enumerate(items)]
    docs += [(900, None), (901, ""), (902, "..."), (903, items[0][1]), (903, items[0][1]), (None, items[1][1])]
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, n_words long").repartition(4)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = [
        (str(r.doc_id), r.n_words, sum(s.end - s.start for s in r.spans), r["items"])
        for r in decontaminate.contamination(df, bench, shard_words=shard_words).collect()
    ]
    assert sorted(got) == brute(docs, items)


def test_spans_are_cut_out_and_columns_stay(spark):
    passage = " ".join(f"p{i}" for i in range(12))
    rows = [(1, f"Keep: {'k ' * 30}({passage.upper()}), end.", "x"), (2, passage, "y"), (3, None, "z"), (4, "clean", "z"), (5, "", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, hit string")
    bench = spark.createDataFrame([(1, passage)], "item_id long, text string")
    out = decontaminate.decontaminated(df, bench)
    assert out.columns == df.columns
    assert sorted((r.doc_id, r.text) for r in out.collect() if r.doc_id != 3) == [(1, f"Keep: {'k ' * 30}(), end."), (4, "clean"), (5, "")]
    assert decontaminate.contamination(df.limit(0), bench).count() == 0
    assert decontaminate.contamination(df, bench.limit(0)).filter("size(spans) > 0").count() == 0


@pytest.mark.parametrize("shard_words", [10**6, 60])
def test_cuts_do_not_depend_on_shards(spark, shard_words):
    rng = random.Random(7)
    w = [f"v{i}" for i in range(400)]
    items = [(i, " ".join(w[12 * i : 12 * i + 18])) for i in range(30)]  # each overlaps the next by six words
    docs = [(i, " ".join(["k%d" % rng.randrange(99) for _ in range(n)] + w[a : a + m])) for i, (n, a, m) in enumerate(
        (rng.randint(0, 60), rng.randrange(340), rng.randint(8, 60)) for _ in range(120))]
    # Words that a cut would make neighbours: two halves of an item around another one.
    docs += [(500 + i, " ".join(["k"] * 60 + w[12 * i : 12 * i + 9] + w[12 * i + 120 : 12 * i + 138] + w[12 * i + 9 : 12 * i + 18])) for i in range(15)]
    docs += [(900, None), (901, ""), (902, "k k"), (902, "k k"), (None, docs[0][1]), (docs[1][0], docs[2][1])]
    windows = {tuple(x[i : i + 10]) for _, t in items for x in [t.split()] for i in range(len(x) - 9)}
    wanted = []
    for d, text in docs:
        x = (text or "").split()
        hit = {k for i in range(len(x) - 9) if tuple(x[i : i + 10]) in windows for k in range(i, i + 10)}
        if 2 * len(hit) <= len(x):
            wanted.append((str(d), text is None, tuple(v for k, v in enumerate(x) if k not in hit)))
    df = spark.createDataFrame([(t, d, "x") for d, t in docs], "text string, doc_id long, spans string").repartition(4)
    out = decontaminate.decontaminated(df, spark.createDataFrame(items, "item_id long, text string"), shard_words=shard_words)
    assert out.columns == df.columns
    assert sorted((str(r.doc_id), r.text is None, tuple((r.text or "").split())) for r in out.collect()) == sorted(wanted)
