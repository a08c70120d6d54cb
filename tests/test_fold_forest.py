"""Forests of all folds against fits of each fold that walk over rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.operators import fold_forest as ff
from tickloom.operators import training as tr

COLUMNS = ["a", "b", "c", "d"]
FOLDS = tr.folds("2024-01-04", "2024-01-07")


@pytest.fixture(scope="module")
def rows(spark):
    """600 rows of nine days; the label follows a and b, more so on later days. Some values and labels are missing."""
    i = F.col("id")
    made = spark.range(600).select(
        F.when(i % 2 == 0, "x").otherwise("y").alias("symbol"), F.expr("timestampadd(MINUTE, cast(id * 20 AS int), TIMESTAMP_NTZ'2024-01-01 00:00:00')").alias("bar_ts"),
        F.when(i % 17 != 3, F.pmod(F.hash(i, F.lit(1)), F.lit(40)) * 1.0).alias("a"), F.pmod(F.hash(i, F.lit(2)), F.lit(9)).alias("b"), (F.pmod(F.hash(i, F.lit(3)), F.lit(2)) == 1).alias("c"),
        F.lit(5.0).alias("d"), (F.pmod(i, F.lit(3)) > 0).alias("market_open"), F.lit("extra").alias("label"),
    )
    label = F.when(i % 19 != 7, F.when(F.coalesce("a", F.lit(0)) + i / 60 > 24, 2).when(F.col("b") > 4, 1).otherwise(0))
    return made.join(spark.range(600).select("id", F.expr("timestampadd(MINUTE, cast(id * 20 AS int), TIMESTAMP_NTZ'2024-01-01 00:00:00')").alias("bar_ts")), "bar_ts").withColumn("mapped_category", label).drop("id").repartition(5)


def plain(table, edges, fold, params):
    """The trees of one fold, row by row."""
    known = [r for r in table if r["mapped_category"] is not None and str(r["bar_ts"])[:10] < fold.date]
    value = lambda r, f: int(sum(float(r[COLUMNS[f]] or 0) > e for e in edges[f]))
    out = []

    def grow(tree, own, key, depth, place):
        labels = [sum(w for r, w in own if r["mapped_category"] == k) for k in range(3)]
        best = None
        for f in ff.tried(key, len(COLUMNS), params) if depth < params.depth else []:
            for cut in range(params.bins - 1):
                sides = [[0] * 3, [0] * 3]
                for r, w in own:
                    sides[value(r, f) > cut][r["mapped_category"]] += w
                if min(sum(s) for s in sides) < params.least_rows:
                    continue
                gain = sum(sum(c * c for c in s) / sum(s) for s in sides) - sum(c * c for c in labels) / sum(labels)
                if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                    best = gain, f, cut
        named = (COLUMNS[best[1]], float(edges[best[1]][best[2]])) if best else (None, None)
        out.append((fold.date, tree, depth, place, *named, labels))
        if best:
            _, f, cut = best
            for side in (0, 1):
                grow(tree, [(r, w) for r, w in own if (value(r, f) > cut) == side], ff.child_key(key, f, cut, side), depth + 1, 2 * place + 1 + side)

    for tree in range(params.trees):
        w = ff.weights(np.array([r["row"] for r in known], np.int64), tree, params)
        key = ff._mixed(params.seed * 0x9E3779B97F4A7C15 + tree * 977 + 13 & ff._MASK)
        grow(tree, list(zip(known, w.tolist())), key, 0, 0)
    return out


@pytest.mark.parametrize("params", [ff.Params(trees=3, depth=3, bins=8), ff.Params(trees=1, depth=2, bins=8, tried=4, bootstrap=False, least_rows=20)])
def test_all_folds_equal_each_fold_alone(spark, rows, params):
    model = ff.fit(rows, COLUMNS, ["symbol", "bar_ts"], FOLDS, params)
    table = rows.withColumn("row", F.xxhash64("symbol", "bar_ts")).collect()
    want = [r for fold in FOLDS for r in plain(table, model.edges, fold, params)]
    assert ff.tree_rows(model) == sorted(want, key=lambda r: (r[0], r[1], r[3]))
    alone = ff.fit(rows.coalesce(1), COLUMNS, ["symbol", "bar_ts"], FOLDS[2:3], params, edges=model.edges)
    assert ff.tree_rows(alone) == [r for r in ff.tree_rows(model) if r[0] == FOLDS[2].date]
    shared = sum(len(n.counts) > 1 for n in model.nodes)
    assert shared > params.trees  # folds do share nodes below the roots


def test_scores_of_the_folds(spark, rows):
    params = ff.Params(trees=5, depth=4, bins=16)
    model = ff.fit(rows, COLUMNS, ["symbol", "bar_ts"], FOLDS, params)
    found = {(r["fold"], r["split"]): r for r in ff.evaluate_folds(model, rows).collect()}
    table = rows.where("mapped_category IS NOT NULL AND market_open").collect()
    for k, fold in enumerate(FOLDS):
        tests = {"test_1_day": fold.date, "test_10_day": fold.shifted(9), "test_full": "9999"}
        for name, last in tests.items():
            own = [r for r in table if fold.date <= str(r["bar_ts"])[:10] <= last]
            bins = np.array([[sum(float(r[c] or 0) > e for e in model.edges[f]) for f, c in enumerate(COLUMNS)] for r in own], np.uint8)
            p = ff.probabilities(model, k, bins)
            assert np.allclose(p.sum(axis=1), 1)
            label = [r["mapped_category"] for r in own]
            row = found.pop((fold.date, name))
            assert row["rows"] == len(own)
            assert math.isclose(row["merror"], sum(int(np.argmax(x)) != y for x, y in zip(p, label)) / len(own))
            assert math.isclose(row["mlogloss"], -sum(math.log(max(x[y], 1e-15)) for x, y in zip(p, label)) / len(own))
            assert row["merror"] < 0.3
    assert not found


def test_folds_without_rows_and_refused_choices(spark, rows):
    early = tr.folds("2023-12-30", "2023-12-31")
    model = ff.fit(rows, COLUMNS, ["symbol", "bar_ts"], early, ff.Params(trees=2, depth=2, bins=4))
    assert [r[4:] for r in ff.tree_rows(model)] == [(None, None, [0, 0, 0])] * 4
    assert np.allclose(ff.probabilities(model, 0, np.zeros((2, 4), np.uint8)), 1 / 3)
    assert ff.evaluate_folds(model, rows.limit(0)).count() == 0
    for folds, bins in (([], 8), (FOLDS, 300)):
        with pytest.raises(ValueError, match="2 to 256 bins"):
            ff.fit(rows, COLUMNS, ["bar_ts"], folds, ff.Params(bins=bins))
    with pytest.raises(ValueError, match="more cut points"):
        ff.fit(rows, ["a"], ["bar_ts"], FOLDS, ff.Params(bins=2), edges=[np.array([1.0, 2.0])])
