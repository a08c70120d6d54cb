"""Ranked search against scores of every document, and bounds against exact scores."""

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tickloom.llm import search, textkit
from test_decontaminate import split


def brute(docs, items, top=20):
    terms = [(d, Counter(split(t))) for d, t in docs]
    terms = [(d, c, sum(c.values())) for d, c in terms if c]
    n_docs, n_terms = len(terms), sum(n for *_, n in terms)
    df = Counter(t for _, c, _ in terms for t in c)
    out = []
    for item, text in items:
        scores = []
        for d, c, n in terms:
            m = 100 - 25 + (25 * n * n_docs) // n_terms
            s = 0
            for t in split(text):
                if c[t]:
                    s += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m))
            if s > 0:
                scores.append((-s, d is None, d, s))
        out += [(item, rank, d, s) for rank, (*_, d, s) in enumerate(sorted(scores, key=lambda x: x[:2] + (x[2] or 0,))[:top], 1)]
    return sorted(out, key=repr)


def tables(n=300):
    rng = random.Random(8)
    words = [f"w{k}" for k in range(200)] + ["Ä", "中", "X1"]
    # Frequent and rare words, so that bounds differ.
    make = lambda k: " ".join(rng.choices(words, weights=[1 / (1 + i) for i in range(len(words))], k=k))
    docs = [(i, make(rng.choice([0, 1, 5, 40, 40, 200]))) for i in range(n)]
    docs += [(1000, None), (1001, ""), (1002, "?!"), (None, make(30)), (1003, make(5000)), (1004, "w1 " * 400), (5, docs[5][1])]
    docs += [(2000 + k, docs[7][1] + " w199") for k in range(30)]  # ties beyond the top
    items = [(i, make(rng.randint(1, 30))) for i in range(25)] + [(30, docs[7][1]), (31, None), (32, "nowhere"), (None, "w199 w199 W198"), (30, docs[7][1])]
    return docs, items


def rows(spark, docs, items, **options):
    d = spark.createDataFrame([(*r, 1, "x") for r in docs], "doc_id long, text string, key int, score string").repartition(3)
    i = spark.createDataFrame([(*r, 2) for r in items], "item_id long, text string, doc_id int")
    return sorted(map(tuple, search.ranked(d, i, **options).collect()), key=repr)


@pytest.mark.parametrize("shard_words", [100_000, 150])
def test_against_brute_force(spark, shard_words):
    docs, items = tables()
    assert rows(spark, docs, items, shard_words=shard_words) == brute(docs, items)


def test_bounds_are_never_below_scores():
    docs, items = tables()
    texts = [t for _, t in docs]
    words = textkit.Words(pa.array(texts), textkit.ALNUM)
    wanted = textkit.Words(pa.array([t for _, t in items]), textkit.ALNUM)
    terms = np.unique(wanted.hashes)
    own = [np.unique(np.searchsorted(terms, wanted.hashes[a:b])) for a, b in zip(wanted.first[:-1], wanted.first[1:])]
    pack = search.Pack(terms, [(o, np.arange(1, len(o) + 1)) for o in own], len(docs), len(words))
    blocks, _ = search._blocks(np.arange(len(docs)), words)
    seen = near = 0
    for width, keys, lengths, slices in search._read_blocks(pa.RecordBatch.from_pylist(blocks, search._INDEX)):
        bound = search.bounds(pack, width, lengths, slices)
        for column, key in enumerate(keys.tolist()):
            mine = Counter(words.hashes[words.first[key] : words.first[key + 1]].tolist())
            times = np.array([mine[t] for t in terms.tolist()])
            offset = pack.offset(lengths[column : column + 1])
            exact = np.array([(w * search.part_score(times[o], offset)).sum() for o, w in pack.items])
            assert (bound[:, column] >= exact).all()
            near += (bound[:, column] <= 1.5 * exact)[exact > 0].sum()
            seen += (exact > 0).sum()
    assert near > 0.8 * seen  # and they are close


def test_signatures_leave_most_documents_out(spark):
    """The exact scores are asked for a part of all pairs only."""
    docs, items = tables(2000)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    index = search.index(d)
    blocks = index.filter("width IS NOT NULL")
    found = brute(docs, items[:10])
    n = len([t for _, t in docs if split(t)])
    pack = search._packed(spark, index, [t for _, t in items[:10]], n, sum(len(split(t)) for _, t in docs))
    least = [min([s for i, _, _, s in found if i == item]) for item, _ in items[:10]]
    reached = search.reaching(blocks, spark.sparkContext.broadcast(pack), spark.sparkContext.broadcast(np.array(least)))
    assert reached.count() < 0.2 * 10 * n


def test_empty_tables(spark):
    docs, items = tables(10)
    nothing = spark.createDataFrame([], "doc_id long, text string")
    assert search.ranked(nothing, spark.createDataFrame(items, "item_id long, text string")).collect() == []
    d = spark.createDataFrame(docs, "doc_id long, text string")
    assert search.ranked(d, spark.createDataFrame([], "item_id long, text string")).collect() == []
    assert search.ranked(d.filter(F.col("doc_id") > 999).filter("doc_id < 1003"), spark.createDataFrame(items, "item_id long, text string")).collect() == []
