"""Boosting against a version that walks over rows, and curves against losses counted one by one."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.operators import boosting as bo

COLUMNS = ["a", "b", "c", "flag"]


def table(n=240, seed=4):
    rng = np.random.default_rng(seed)
    a, b, c = rng.normal(size=n), rng.integers(0, 6, n), rng.normal(size=n)
    label = np.where(a + 0.4 * b > 1.5, 1, np.where(c > 0.3, 2, 0))
    label = np.where(rng.random(n) < 0.1, rng.integers(0, 3, n), label)
    rows = []
    for i in range(n):
        rows.append((i, None if i % 17 == 0 else float(a[i]), int(b[i]), float(c[i]), bool(c[i] > 0), None if i == 5 else int(label[i]), i % 4))
    return rows


def frame(spark, rows, parts=3):
    return spark.createDataFrame(rows, "id long, a double, b int, c double, flag boolean, mapped_category int, part int").repartition(parts)


def brute(rows, edges, params, train, sets):
    """Trees as nested dictionaries and losses per round, one row at a time."""
    data = [([0.0 if v is None else float(v) for v in r[1:5]], r[5], train(r), [k for k, s in sets.items() if s(r)]) for r in rows if r[5] is not None]
    bins = [[sum(e < v for e in edges[f]) for f, v in enumerate(x)] for x, *_ in data]
    margins = [[0.0] * 3 for _ in data]
    scale, trees, curve = 1 << 30, [], []

    def probabilities(m):
        e = [float(x) for x in np.exp(np.array(m) - max(m))]
        return [x / (e[0] + e[1] + e[2]) for x in e]

    for _ in range(params.rounds):
        p = [probabilities(m) for m in margins]
        level = []
        for k in range(3):
            g = [round((p[i][k] - (y == k)) * scale) for i, (_, y, *_) in enumerate(data)]
            h = [round(max(2 * p[i][k] * (1 - p[i][k]), 1e-16) * scale) for i in range(len(data))]
            score = lambda x, y: (x / scale) ** 2 / (y / scale + params.l2)

            def grow(members, depth):
                gs, hs = sum(g[i] for i in members), sum(h[i] for i in members)
                best = None
                if depth < params.depth:
                    for f in range(4):
                        for cut in range(params.bins - 1):
                            left = [i for i in members if bins[i][f] <= cut]
                            lg, lh = sum(g[i] for i in left), sum(h[i] for i in left)
                            if lh >= params.least_curvature * scale and hs - lh >= params.least_curvature * scale:
                                gain = score(lg, lh) + score(gs - lg, hs - lh) - score(gs, hs)
                                if gain > 1e-6 and (best is None or gain > best[0]):
                                    best = gain, f, cut
                if best is None:
                    return {"value": -params.rate * (gs / scale) / (hs / scale + params.l2)}
                _, f, cut = best
                return {"f": f, "cut": cut, "l": grow([i for i in members if bins[i][f] <= cut], depth + 1),
                        "r": grow([i for i in members if bins[i][f] > cut], depth + 1)}

            level.append(grow([i for i in range(len(data)) if data[i][2]], 0))
        trees.append(level)
        for i in range(len(data)):
            for k, node in enumerate(level):
                while "f" in node:
                    node = node["l"] if bins[i][node["f"]] <= node["cut"] else node["r"]
                margins[i][k] += node["value"]
        p = [probabilities(m) for m in margins]
        for name in sets:
            inside = [i for i in range(len(data)) if name in data[i][3]]
            wrong = sum(p[i].index(max(p[i])) != data[i][1] for i in inside)
            loss = -sum(math.log(max(p[i][data[i][1]], 1e-15)) for i in inside)
            curve.append((len(trees), name, len(inside), wrong / len(inside), loss / len(inside)))
    return trees, curve


def nested(tree, node=0):
    if tree.feature[node] < 0:
        return {"value": tree.value[node]}
    return {"f": int(tree.feature[node]), "cut": int(tree.bin[node]), "l": nested(tree, 2 * node + 1), "r": nested(tree, 2 * node + 2)}


@pytest.fixture(scope="module")
def fitted(spark):
    params = bo.Params(rounds=12, depth=3, bins=8)
    rows = frame(spark, table())
    sets = {"train": F.col("part") > 0, "test": F.col("part") == 0}
    return bo.fit(rows, COLUMNS, ["id"], params, F.col("part") > 0, sets), rows, sets


def test_trees_and_curves_equal_brute_force(spark, fitted):
    model, rows, sets = fitted
    trees, curve = brute(table(), model.edges, model.params, lambda r: r[6] > 0, {"train": lambda r: r[6] > 0, "test": lambda r: r[6] == 0})
    assert [[nested(t) for t in level] for level in model.trees] == trees
    for found in (model.curve, [tuple(r) for r in bo.loss_curves(model, rows, sets).orderBy("round", F.desc("eval_set")).collect()]):
        assert [r[:4] for r in found] == [r[:4] for r in curve]
        assert all(math.isclose(x[4], y[4], rel_tol=1e-9) for x, y in zip(found, curve))
    assert model.curve[-2][4] < model.curve[0][4]


def test_scores_are_the_last_losses(spark, fitted):
    model, rows, _ = fitted
    scored = bo.class_probabilities(model, rows).where("part = 0 AND mapped_category IS NOT NULL").collect()
    wrong = sum(r.pred != r.mapped_category for r in scored)
    loss = -sum(math.log((r.p0, r.p1, r.p2)[r.mapped_category]) for r in scored)
    last = model.curve[-1]
    assert (len(scored), wrong / len(scored)) == (last[2], last[3]) and math.isclose(loss / len(scored), last[4], rel_tol=1e-9)
    scores = {r.feature: r.score for r in bo.importances(model, spark).collect()}
    assert math.isclose(sum(scores.values()), 1) and scores["a"] > 0.1 and scores["c"] > 0.1
    nodes = bo.model_table(model, spark)
    assert nodes.where("feature IS NOT NULL AND cut IS NULL").count() == 0 and nodes.agg(F.max("round")).first()[0] == 12


def test_partitions_don_t_matter_and_samples_repeat(spark):
    params = bo.Params(rounds=2, depth=2, bins=16, subsample=0.6)
    models = [bo.fit(frame(spark, rows, parts), COLUMNS, ["id"], params) for rows, parts in ((table(), 1), (table()[::-1], 5))]
    trees = [[[nested(t) for t in level] for level in m.trees] for m in models]
    assert trees[0] == trees[1]
    whole = bo.fit(frame(spark, table()), COLUMNS, ["id"], bo.Params(rounds=2, depth=2, bins=16))
    assert [[nested(t) for t in level] for level in whole.trees] != trees[0]


def test_stops_after_rounds_without_gain(spark):
    rows = frame(spark, table(150, 9), 2)
    sets = {"train": F.col("part") > 0, "held_out": F.col("part") == 0}
    model = bo.fit(rows, COLUMNS, ["id"], bo.Params(rounds=30, depth=4, rate=1.0, bins=8, least_curvature=0.1, patience=3), F.col("part") > 0, sets, "held_out")
    losses = [r[4] for r in model.curve if r[1] == "held_out"]
    best = losses.index(min(losses))
    assert len(model.trees) == best + 1 and len(losses) == best + 4 < 30
    with pytest.raises(ValueError):
        bo.fit(rows, COLUMNS, ["id"], stop_on="nowhere")
