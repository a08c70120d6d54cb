"""Near-duplicates against brute force."""

import functools
import random

import pytest

from tickloom.llm import components, near_dup


def brute(rows, width, percent):
    sets = {}
    for d, t in rows:
        w = (t or "").lower().split()
        sets[d] = {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()
    parent = {d: d for d in sets}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((top(a), top(b)))
                parent[y] = x
    return sorted((d, len(sets[d]), top(d), top(d) == d) for d in ids)


def corpus(seed, n, drift):
    """Groups of copies with words changed, some far from the group's first."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    bases = [[rng.choice(words) for _ in range(rng.choice([3, 12, 60, 300]))] for _ in range(12)]
    rows = []
    for i in range(n):
        text = list(rng.choice(bases[:4] if i % 3 else bases))
        for _ in range(int(rng.random() * drift * len(text))):
            text[rng.randrange(len(text))] = rng.choice(words)
        rows.append((i, " ".join(w.upper() if rng.random() < 0.1 else w for w in text)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("width, percent", [(2, 80), (5, 80)])
def test_against_brute_force(spark, width, percent):
    rows = corpus(3, 150, 0.12) + [(1000, None), (1001, ""), (1002, " \n"), (1003, "one"), (1004, "One"), (1005, "x " * 3000)]
    df = spark.createDataFrame([(d, t, 5, 6) for d, t in rows], "doc_id long, text string, n long, node long").repartition(5)
    got = sorted(tuple(r) for r in near_dup.near_duplicates(df, width, percent).collect())
    assert got == brute(rows, width, percent)


def test_nulls_repeats_and_empty(spark):
    rows = [(None, "a b c d e f g"), (None, "a b c d e f g"), (7, "a b c d e f g"), (7, "a b c d e f g"), (3, "q r s t u v w")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r.doc_id), str(r.component_id), r.kept) for r in near_dup.near_duplicates(df).collect())
    assert got == sorted([("None", "None", True)] * 2 + [("7", "7", True)] * 2 + [("3", "3", True)])
    assert near_dup.near_duplicates(df.limit(0)).count() == 0
    assert near_dup.without_near_duplicates(df).columns == df.columns


def test_components_of_long_paths(spark):
    rng = random.Random(1)
    order = list(range(300))
    rng.shuffle(order)
    links = list(zip(order, order[1:])) + [(1000, 1001), (None, 3), (5, 5)]
    found = {r.node: r.label for r in components.labels(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {found[i] for i in range(300)} == {0} and found[1001] == 1000


def test_sketch_estimates(spark):
    import numpy as np

    rng = np.random.default_rng(0)
    for n in (30, 400, 5000):
        shared = rng.integers(0, 1 << 63, int(n * 0.9), dtype=np.uint64)
        sides = [np.unique(np.concatenate([shared, rng.integers(0, 1 << 63, n - len(shared), dtype=np.uint64)])) * np.uint64(2) for _ in "ab"]
        rows = [(k, n, *(lambda c, s: (c, s.tolist()))(*near_dup.odd_sketch(np.sort(s)))) for k, s in enumerate(sides)]
        nodes = spark.createDataFrame(rows, "node long, n long, samples long, sketch array<long>")
        (row,) = near_dup.candidates(spark.createDataFrame([(0, 1)], "a long, b long"), nodes, 80).collect()
        assert abs(row.score - 0.9 / 1.1) < 0.08


def test_sketches_keep_pairs_at_the_limit(spark):
    import numpy as np

    rng, rows, pairs = np.random.default_rng(11), [], []
    for union in (60, 125, 250, 500, 1000):
        for _ in range(2500):
            found = rng.integers(0, 1 << 64, union, dtype=np.uint64)
            one = union // 10
            for side in (found[one:], np.concatenate([found[:one], found[2 * one :]])):
                rows.append((len(rows), len(side), *(lambda c, s: (c, s.tolist()))(*near_dup.odd_sketch(np.sort(side)))))
            pairs.append((len(rows) - 2, len(rows) - 1))
    nodes = spark.createDataFrame(rows, "node long, n long, samples long, sketch array<long>")
    kept = near_dup.candidates(spark.createDataFrame(pairs, "a long, b long"), nodes, 80)
    assert kept.count() == len(pairs)


def test_blocks_go_on_from_the_start_when_the_main_component_takes_a_smaller_label(spark):
    base = [f"w{i}" for i in range(100)]
    # 1 and 3 are linked with 9 only; 2 is linked with none, but the others hold its shingles.
    texts = {1: base[12:], 2: base[:40], 3: base[:-12], 9: base}
    docs = spark.createDataFrame([(d, " ".join(t)) for d, t in texts.items()], "doc_id long, text string")
    nodes = near_dup.signatures(docs, 5).selectExpr("doc_id AS node", "n", "samples", "sketch", "array_repeat(7L, 32) AS bands")
    members = spark.createDataFrame([(7, 0, d) for d in texts], "key long, band int, node long")
    state = near_dup._State(docs, nodes.select("node", "n", "samples", "sketch"), 5, 80)
    near_dup._compare_rest(state, members, nodes, block=2)
    got = sorted((r.node, r.label) for r in state.labelled(docs.selectExpr("doc_id AS node"), "node", "label").collect())
    assert got == [(1, 1), (2, 2), (3, 1), (9, 1)]


def test_small_blocks_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "_compare_rest", functools.partial(near_dup._compare_rest, block=2))
    rows = corpus(9, 150, 0.2)
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 2, 80).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, 2, 80)


def test_pairs_compared_grow_with_the_rows_of_a_group(spark, monkeypatch, width=2):
    """Copies that are just too far from a group meet few of its others, and the components are those of brute force."""
    rng = random.Random(4)
    words = [f"w{i}" for i in range(5000)]
    base = [rng.choice(words) for _ in range(150)]
    rows = []
    for i in range(240):
        text = list(base)
        # Changed words cost two shingles each: a third of the copies is a bit further off than the limit.
        for at in rng.sample(range(150), rng.choice([1, 2, 10])):
            text[at] = rng.choice(words)
        rows.append((i, " ".join(text)))
    compare, pairs = near_dup._State.compare, []

    def counted(self, left):
        pairs.append(left.count())
        compare(self, left)

    monkeypatch.setattr(near_dup._State, "compare", counted)
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width, 80).collect()
    want = brute(rows, width, 80)
    assert sorted(tuple(r) for r in got) == want
    assert sum(kept for *_, kept in want) > 40
    assert sum(pairs[1:]) < 5 * len(rows)
