"""Line dedup against brute force with edit distances."""

import random

from tickloom.llm import lines


def distance(x, y):
    line = list(range(len(y) + 1))
    for i, a in enumerate(x, 1):
        corner, line[0] = line[0], i
        for j, b in enumerate(y, 1):
            corner, line[j] = line[j], min(corner + (a != b), line[j] + 1, line[j - 1] + 1)
    return line[-1]


def brute(rows):
    every = []
    for d, t in rows:
        for k, line in enumerate((t or "").split("\n")):
            if w := line.lower().split():
                every.append(((10**18 if d is None else d, k), w))
    out = []
    for at, w in every:
        equal = [b for b, x in every if b < at and x == w]
        near = [b for b, x in every if b < at and min(len(x), len(w)) >= 8 and abs(len(x) - len(w)) <= 1 and distance(x, w) == 1]
        # The first line of a group is the one that looks for near ones.
        if equal:
            out.append((at, min(equal), 0))
        elif near:
            out.append((at, min(near), 1))
    return sorted(set(out))


def corpus(seed, n):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(30)]
    bases = [[rng.choice(words[: rng.choice([2, 30])]) for _ in range(rng.choice([1, 3, 7, 8, 9, 10, 15, 40]))] for _ in range(14)]
    rows = []
    for i in range(n):
        text = []
        for _ in range(rng.randint(0, 6)):
            line = list(rng.choice(bases))
            for _ in range(rng.choice([0, 1, 1, 2])):
                k = rng.randrange(len(line) + 1)
                how = rng.random()
                if how < 0.4:
                    line.insert(k, rng.choice(words))
                elif how < 0.7 and len(line) > 1:
                    del line[k - 1]
                else:
                    line[k - 1] = rng.choice(words)
            text.append(rng.choice([" ", "  "]).join(w.upper() if rng.random() < 0.1 else w for w in line))
        rows.append((i, rng.choice(["\n", "\n\n"]).join(text)))
    return rows


def test_against_brute_force(spark):
    rows = corpus(2, 120) + [(None, "w1 w2 w3 w4 w5 w6 w7 w8 w9\n\n x "), (900, None), (901, ""), (902, "x\nx"), (903, " \n\t")]
    df = spark.createDataFrame([(d, t, 1, 2) for d, t in rows], "doc_id long, text string, line long, n long").repartition(5)
    got = sorted(
        ((10**18 if r.doc_id is None else r.doc_id, r.line), (r.first_doc_id, r.first_line), r.edits) for r in lines.line_duplicates(df).collect()
    )
    assert got == brute(rows)
    report = {r.doc_id: r for r in lines.line_report(df).collect()}
    assert report[902].n_lines == 2 and report[902].n_equal >= 1 and report[900].n_lines == 0 and len(report) == len(rows)
    kept = {r.doc_id: r.text for r in lines.without_duplicates(df).collect()}
    gone = {(None if d == 10**18 else d, k) for (d, k), _, _ in got}
    for d, t in rows:
        want = t if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if (d, k) not in gone)
        assert kept[d] == want


def test_repeats_and_empty(spark):
    df = spark.createDataFrame([(1, "a b\nc"), (1, "a b\nc"), (2, "c")], "doc_id long, text string")
    assert [(r.doc_id, r.line, r.first_doc_id, r.first_line) for r in lines.line_duplicates(df).collect()] == [(2, 0, 1, 1)]
    assert lines.line_duplicates(df.limit(0)).count() == 0
    assert lines.line_report(df.limit(0)).count() == 0
