"""Quality rules, mixing and chat formatting on small hand-made tables."""

import random
import re

import pytest

from tickloom.llm import chat, mixing, rules

ODD = [
    (1, None), (2, ""), (3, " \t\n"), (4, "a b c a b c"), (5, "a a a a a"), (6, "x\ny\nx\n\n \nx"), (7, "one #$ | two"), (8, "a b c d a b"),
    (9, "é ö ü x"), (10, "w " * 30_000), (10, "w " * 30_000), (None, " ".join(f"w{i}" for i in range(60))),
]


def measured(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen = {}
    for g in grams:
        seen[g] = seen.get(g, 0) + 1
    covered = {i + k for i, g in enumerate(grams) if seen[g] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines), len(lines) - len(set(lines)), len(covered)


def test_measurements(spark):
    rng = random.Random(1)
    rows = ODD + [(100 + i, " ".join(rng.choice("abcd") for _ in range(rng.randint(0, 40)))) for i in range(80)]
    df = spark.createDataFrame([(d, t, "clash", 5) for d, t in rows], "doc_id long, text string, n_words string, h long")
    got = sorted(
        (str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_lines, r.n_dup_lines, r.n_repeat_words) for r in rules.ledger(df).collect()
    )
    assert got == sorted((str(d), *measured(t)) for d, t in rows)


def test_policies_and_ablation(spark):
    df = spark.createDataFrame(ODD, "doc_id long, text string")
    book = rules.ledger(df).cache()
    bits = [r.failure_bits for r in book.collect()]
    for policy in rules.POLICIES:
        mask = rules.mask(policy)
        assert book.filter(rules.passes(policy)).count() == sum(b & mask == 0 for b in bits)
        found = {r.rule: (r.n_failed, r.n_only) for r in rules.ablation(book, policy).collect()}
        for rule in rules.RULES:
            if rule.name in rules.POLICIES[policy]:
                one = 1 << rule.bit
                assert found[rule.name] == (sum(b & one > 0 for b in bits), sum(b & mask == one for b in bits))
    assert rules.ledger(df.limit(0)).count() == 0
    kept = rules.rejected_removed(df, "v2")
    assert kept.columns == df.columns and [r.doc_id for r in kept.collect()] == [None]


def waterfill(sizes):
    """Targets by capping and sharing the excess again, as often as needed."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, free, left = {}, set(names), float(sum(sizes.values()))
    while free:
        total = sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / total > 3 * sizes[s]}
        if not over:
            return target | {s: left * weight[s] / total for s in free}
        for s in over:
            target[s] = 3.0 * sizes[s]
            left -= 3 * sizes[s]
        free -= over
    return target


@pytest.mark.parametrize("bucket_rows", [3, 1000])
def test_mix(spark, bucket_rows):
    rng = random.Random(2)
    rows = [(i, rng.choice(["b", "a", "a", "a", "a", "z", None, "É"]) if i % 9 else "tiny" * (i == 0) or "a", "w " * rng.randint(0, 50)) for i in range(300)]
    rows += [(1000, "none", None), (None, "b", "x y"), (5, "b", "q " * 7), (5, "b", "q " * 7)]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, source string, text string, size string, key long").repartition(7)
    got = [r.asDict() for r in mixing.mix(df, bucket_rows=bucket_rows).collect()]
    sizes = {}
    for _, s, t in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    goal = waterfill(sizes)
    assert len(got) == len(rows)
    taken = {}
    for r in got:
        assert 0 <= r["taken"] <= 3 * r["size"]
        key = (r["source_size"], round(r["target"], 6))
        taken[key] = taken.get(key, 0) + r["taken"]
    for s, n in sizes.items():
        if n:
            assert taken[n, round(goal[s], 6)] == int(goal[s] + 1e-9)
    again = [r.asDict() for r in mixing.mix(df.repartition(2), bucket_rows=17).collect()]
    key = lambda r: str(sorted(r.items(), key=str))
    assert sorted(map(key, got)) == sorted(map(key, again))
    assert mixing.mix(df.limit(0)).count() == 0


def test_mixed_documents_keep_their_columns(spark):
    rows = [(i, "ab"[i % 2], "w " * 10, i) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string, _copies long")
    out = mixing.mixed(df)
    taken = {r.doc_id: r.taken for r in mixing.mix(df).collect()}
    counts = {}
    for r in out.collect():
        counts[r.doc_id] = counts.get(r.doc_id, 0) + 1
    assert out.columns == df.columns
    assert counts == {d: -(-t // 10) for d, t in taken.items() if t}


def collapsed(rows):
    talks = {}
    for c, *turn in rows:
        talks.setdefault(c, []).append(turn)
    none_first = lambda t: [(x is not None, x) for x in t]
    talks = {c: [tuple(t[1:]) for t in sorted(turns, key=none_first)] for c, turns in talks.items()}
    out = {}
    for c, t in talks.items():
        if any(len(o) > len(t) and o[: len(t)] == t for o in talks.values()):
            continue
        same = sorted((x for x in talks if talks[x] == t), key=lambda x: (x is None, x))
        if same[0] == c:
            out[c] = (len(t), len(same), "".join(f"<|im_start|>{r or 'unknown'}\n{(x or '').replace('<|', '< |')}<|im_end|>\n" for r, x in t))
    return out


@pytest.mark.parametrize("piece", [2, 1024])
def test_chat(spark, piece):
    rng = random.Random(3)
    rows = []
    for c in range(60):
        n = rng.randint(1, 7)
        start = rng.choice([0, 0, 5])
        rows += [(c, start + k, rng.choice(["user", "user", None]), rng.choice(["hi", "hi", "ho <|im_end|>"])) for k in range(n)]
    rows += [(100, 0, "user", None), (101, 0, "user", ""), (102, None, "user", "x"), (102, 1, "user", "x"), (102, 1, "user", "x"), (None, 0, "user", "alone")]
    rows += [(200, k, "user", f"t{k}") for k in range(30)] + [(201, k, "user", f"t{k}") for k in range(17)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, position long").repartition(5)
    got = {}
    for r in sorted(chat.chat_documents(df, piece).collect(), key=lambda r: r.part):
        n, logged, text = got.get(r.conv_id, (0, 0, ""))
        got[r.conv_id] = (r.n_turns, r.n_logged, text + r.text)
    assert got == collapsed(rows)
    assert chat.chat_documents(df.limit(0)).count() == 0
