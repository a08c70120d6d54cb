"""Fuzzy repeated passages: chains against a quadratic search, planted passages, odd rows."""

import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tickloom.llm import passages


def quadratic(at, ref):
    """Best score of a chain, each match from the best earlier one by the same costs."""
    score = [1.0] * len(at)
    for j in range(len(at)):
        for i in range(j):
            if at[i] < at[j] and ref[i] < ref[j]:
                score[j] = max(score[j], 1.0 + score[i] - passages.JUMP * (at[j] - at[i] + ref[j] - ref[i]))
    return max(score)


@settings(max_examples=300, deadline=None)
@given(st.sets(st.tuples(st.integers(0, 30), st.integers(0, 30)), min_size=2, max_size=25))
def test_chains_are_the_best(points):
    at, ref = map(list, zip(*sorted(points)))
    chains = passages.best_chains(at, ref)
    seen = [k for c in chains for k in c]
    assert len(seen) == len(set(seen))
    for c in chains:
        assert all(at[a] < at[b] and ref[a] < ref[b] for a, b in zip(c, c[1:]))
    if chains:
        steps = zip(chains[0], chains[0][1:])
        score = len(chains[0]) - passages.JUMP * sum(at[b] - at[a] + ref[b] - ref[a] for a, b in steps)
        assert abs(score - quadratic(at, ref)) < 1e-9
    else:
        assert quadratic(at, ref) <= 1.0 + 1e-9


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=8), st.lists(st.integers(0, 3), max_size=8))
def test_equal_words_of_short_sequences(x, y):
    kept = passages.equal_words(x, y)
    assert 0 <= kept <= min(len(x), len(y))
    assert kept == len(x) if x == y else kept <= max(len(x), len(y))


def words(rng, n):
    return ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(n)]


def found(spark, rows, **options):
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, block long, ref string").repartition(4)
    return passages.repeated_passages(df, **options).collect()


def test_planted_passages_are_found_and_nothing_else(spark):
    rng = random.Random(4)
    exact, fuzzy, short = words(rng, 60), words(rng, 150), words(rng, 30)
    edited = list(fuzzy)
    for k in range(6, 150, 12):
        edited[k] = "changed"
    del edited[70]
    docs = {i: words(rng, rng.randint(0, 300)) for i in range(40)}
    for d in (3, 9, 21):
        docs[d][10:10] = exact
    docs[5] += fuzzy
    docs[30][:0] = edited
    docs[11] += short
    docs[12] += short
    docs[35] = docs[11] and [w.upper() for w in docs[7]]
    rows = [(d, " ".join(w)) for d, w in docs.items()] + [(100, None), (101, ""), (102, "a b"), (None, " ".join(docs[9]))]
    for options in ({}, {"block_bytes": 4000}, {"block_bytes": 4000, "common": 1}):
        got = {(r.doc_id, r.ref_doc_id): r for r in found(spark, rows, **options)}
        wanted = {(9, 3), (21, 3), (30, 5), (None, 9), (None, 3)}
        if len(docs[7]) >= 50:
            wanted.add((35, 7))
        assert set(got) == wanted
        assert got[21, 3].n_words == got[21, 3].n_equal == 60 and got[21, 3].start_word == 10
        assert got[30, 5].n_words >= 140 and got[30, 5].n_equal >= 0.85 * got[30, 5].n_words


def test_a_quilt_of_two_documents(spark):
    rng = random.Random(5)
    one, two = words(rng, 40), words(rng, 40)
    rows = [(1, " ".join(one)), (2, " ".join(two)), (3, " ".join(one + two)), (4, " ".join(words(rng, 30) + one + two))]
    got = {(r.doc_id, r.ref_doc_id) for r in found(spark, rows)}
    assert got >= {(3, 1), (3, 2), (4, 1), (4, 2)}


def test_repeats_and_empty(spark):
    text = " ".join(words(random.Random(6), 80))
    assert found(spark, [(1, text), (1, text)]) == []
    assert [(r.doc_id, r.ref_doc_id, r.n_words) for r in found(spark, [(1, text), (2, text), (2, text)])] == [(2, 1, 80)]
    assert found(spark, []) == []


@settings(max_examples=300, deadline=None)
@given(st.sets(st.tuples(st.integers(0, 60), st.integers(0, 60)), min_size=2, max_size=30), st.integers(1, 12))
def test_chains_are_the_best_within_the_gap(points, scale):
    at, ref = map(list, zip(*sorted((scale * a, scale * b) for a, b in points)))
    score = [1.0] * len(at)
    for j in range(len(at)):
        for i in range(j):
            if 0 < at[j] - at[i] <= passages.GAP and 0 < ref[j] - ref[i] <= passages.GAP:
                score[j] = max(score[j], 1.0 + score[i] - passages.JUMP * (at[j] - at[i] + ref[j] - ref[i]))
    chains = passages.best_chains(at, ref)
    for c in chains:
        assert all(0 < at[b] - at[a] <= passages.GAP and 0 < ref[b] - ref[a] <= passages.GAP for a, b in zip(c, c[1:]))
    if chains:
        steps = zip(chains[0], chains[0][1:])
        best = len(chains[0]) - passages.JUMP * sum(at[b] - at[a] + ref[b] - ref[a] for a, b in steps)
        assert abs(best - max(score)) < 1e-9
    else:
        assert max(score) <= 1.0 + 1e-9


def test_two_passages_of_a_pair_far_apart(spark):
    rng = random.Random(8)
    rows, wanted = [], set()
    for k, (first, gap, second) in enumerate([(60, 100, 60), (60, 500, 60), (200, 300, 200), (200, 100, 1000)]):
        one, two = words(rng, first), words(rng, second)
        rows += [(2 * k + d, " ".join(one + words(rng, gap) + two)) for d in (0, 1)]
        wanted |= {(2 * k + 1, 0, first), (2 * k + 1, first + gap, second)}
    assert {(r.doc_id, r.start_word, r.n_words) for r in found(spark, rows)} == wanted


def test_passages_with_many_changed_words(spark):
    rng, rows = random.Random(9), []
    for k in range(200):
        text = words(rng, 60)
        copy = ["changed" + w if i % 8 == 4 else w for i, w in enumerate(text)]
        rows += [(2 * k + d, " ".join(words(rng, 20) + t + words(rng, 20))) for d, t in ((0, text), (1, copy))]
    assert len({r.doc_id for r in found(spark, rows)}) >= 0.95 * 200


def test_a_passage_whose_seeds_stand_scattered_in_earlier_documents(spark):
    rng = random.Random(10)
    passage = words(rng, 70)
    rows = [(k, " ".join(w for _ in range(20) for w in words(rng, 8) + passage[k : k + 5])) for k in range(66)]
    rows += [(d, " ".join(words(rng, 30) + passage + words(rng, 30))) for d in (500, 900)]
    for options in ({}, {"block_bytes": 4000, "common": 1}):
        got = {(r.doc_id, r.ref_doc_id): r for r in found(spark, rows, **options)}
        assert (900, 500) in got and got[900, 500].n_words == 70


def test_seeds_travel_once_and_packed(spark, monkeypatch):
    """Seeds go to buckets and answers back; no exchange deals single seeds by their hash."""
    plans, store = [], passages.stored

    def planned(df, label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return store(df, label)

    monkeypatch.setattr(passages, "stored", planned)
    words = [f"w{k}" for k in range(70)]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, "x " + " ".join(words)), (3, " ".join(words[::-1]))], "doc_id long, text string")
    found = passages.repeated_passages(docs).collect()
    assert {(r.doc_id, r.ref_doc_id) for r in found} == {(2, 1)} and max(r.n_words for r in found) >= 50
    assert "hashpartitioning(hash" not in plans[0] and "hashpartitioning(bucket" in plans[0] and "Join" not in plans[0]


def least_edits(x, y):
    """Words that an alignment of least edit distance keeps, by the whole table."""
    line = [(j, 0) for j in range(len(y) + 1)]
    for i, a in enumerate(x, 1):
        before, line = line, [(i, 0)]
        for j, b in enumerate(y, 1):
            match = (before[j - 1][0], before[j - 1][1] - 1) if a == b else (before[j - 1][0] + 1, before[j - 1][1])
            line.append(min(match, (before[j][0] + 1, before[j][1]), (line[-1][0] + 1, line[-1][1])))
    return -line[-1][1]


@settings(max_examples=500, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=9), st.lists(st.integers(0, 2), max_size=9))
def test_equal_words_are_those_of_the_whole_table(x, y):
    short = len(x) == len(y) and sum(a == b for a, b in zip(x, y)) >= len(x) - 1
    assert passages.equal_words(x, y) == (sum(a == b for a, b in zip(x, y)) if short else least_edits(x, y))


@settings(max_examples=500, deadline=None)
@given(st.lists(st.integers(0, 1), max_size=40), st.lists(st.integers(0, 1), max_size=40))
def test_extension_stops_where_sums_say(x, y):
    same = np.array([a == b for a, b in zip(x, y)], bool)
    gain = np.cumsum(np.where(same, 1, -passages.WRONG))
    stop = np.flatnonzero(np.maximum.accumulate(np.maximum(gain, 0)) - gain > passages.DROP)
    gain = gain[: stop[0]] if len(stop) else gain
    end = int(gain.argmax()) + 1 if len(gain) and gain.max() > 0 else 0
    assert passages.extension(np.array(x, np.int64), np.array(y, np.int64)) == (end, int(same[:end].sum()))


class Counted:
    """A word that counts its comparisons."""

    compared = 0

    def __init__(self, word):
        self.word = word

    def __eq__(self, other):
        Counted.compared += 1
        return self.word == other.word

    def __ne__(self, other):
        return not self == other


def test_alignment_looks_at_few_words():
    """Beyond a chain's end a few words are read, and of a gap only the middle that differs is laid out."""
    many = lambda values: [Counted(v) for v in values]
    column = lambda values: np.array([*many(values), None], object)[:-1]
    Counted.compared = 0
    assert passages.extension(column(range(500)), column(range(1000, 1500))) == (0, 0)
    assert Counted.compared <= 4
    Counted.compared = 0
    one, two = [*range(30), 91, 92, *range(30, 60)], [*range(30), 93, 94, 95, *range(30, 60)]
    assert passages.equal_words(many(one), many(two)) == 60
    assert Counted.compared < 200
