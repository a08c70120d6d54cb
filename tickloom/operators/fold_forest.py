"""Forests of all walk-forward folds at once, from counts that folds share.

Fold k trains on every day before its date, so it is fold k - 1 plus a few days. Rows are binned once and carry the first fold
that they train. A level of all trees of all folds is one pass: tasks count labels by (node, feature, first fold, bin), and
the counts of fold k are the sums over the first folds up to k. Folds that have cut alike so far share their nodes, and so their rows
are walked and counted once; where two folds cut differently the rows go on in both. Bootstrap weights depend on the row and the tree and the columns tried
on the tree and the node, never on the fold, so each fold's forest is the one that a fit of it alone gives.
Counts are whole numbers, so trees don't depend on partitions. The driver gets a row per fold and node, which is the model's size.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.operators.boosting import _as_doubles, _binary, _cut, _features, _fixed, bin_edges, losses
from tickloom.operators.training import CLASSES, LABEL, SEED, TREES, Fold
from tickloom.sources.storage import stage


@dataclass(frozen=True)
class Params:
    """Numbers of trees and seed are fixed values. ``tried``: columns tried at a node, by default the root of their number."""

    trees: int = TREES
    depth: int = 6
    bins: int = 32
    least_rows: int = 1
    tried: int | None = None
    bootstrap: bool = True
    seed: int = SEED


@dataclass
class Node:
    """A node that one or more folds share; ``cuts`` gives its children by (feature, bin), ``cut_of`` and ``counts`` each fold's cut and labels."""

    tree: int
    key: int
    depth: int
    cuts: dict[tuple[int, int], tuple[int, int]] = field(default_factory=dict)
    cut_of: dict[int, tuple[int, int]] = field(default_factory=dict)
    counts: dict[int, np.ndarray] = field(default_factory=dict)


@dataclass
class FoldForests:
    """The first ``params.trees`` nodes are the roots."""

    columns: list[str]
    edges: list[np.ndarray]
    folds: list[Fold]
    params: Params
    nodes: list[Node] = field(default_factory=list)


_MASK = (1 << 64) - 1


def _mixed(x):
    """64 bits of a number or an array of them."""
    for _ in range(2):
        x = (x ^ (x >> 33)) * 0xFF51AFD7ED558CCD & _MASK if isinstance(x, int) else (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> 33) if isinstance(x, int) else x ^ (x >> np.uint64(33))


#: Shares of rows that a bootstrap sample holds at most 0, 1, 2, ... times.
_TIMES = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(9)])


def weights(row: np.ndarray, tree: int, params: Params) -> np.ndarray:
    """How often the tree's bootstrap sample holds each row, by the row's hash."""
    if not params.bootstrap:
        return np.ones(len(row), np.int64)
    drawn = _mixed(row.view(np.uint64) ^ np.uint64(_mixed(params.seed * 0x9E3779B97F4A7C15 + tree + 1 & _MASK)))
    return np.searchsorted(_TIMES, (drawn >> np.uint64(11)).astype(np.float64) / float(1 << 53))


def tried(key: int, n: int, params: Params) -> list[int]:
    """Columns that a node tries: those whose hashes with the node's key are least."""
    wanted = params.tried or max(1, round(math.sqrt(n)))
    return sorted(sorted(range(n), key=lambda f: _mixed(key ^ (f + 1) * 0xC2B2AE3D27D4EB4F & _MASK))[:wanted])


def child_key(key: int, feature: int, cut: int, side: int) -> int:
    return _mixed((key * 31 + feature) * 1024 + cut * 2 + side + 1 & _MASK)


def best_cuts(counts: np.ndarray, params: Params) -> tuple[np.ndarray, np.ndarray]:
    """(bin, gain) of each fold's best cut of a feature; ``counts`` is fold x bin x label. Gains are of the Gini impurity, in rows; bin -1: none."""
    left = np.cumsum(counts, axis=1)[:, :-1]
    total = counts.sum(axis=1, keepdims=True)
    right = total - left

    def purity(c):
        n = c.sum(axis=2)
        return (c.astype(np.float64) ** 2).sum(axis=2) / np.maximum(n, 1), n

    (a, n_a), (b, n_b), (whole, _) = purity(left), purity(right), purity(total)
    gain = np.where((n_a >= params.least_rows) & (n_b >= params.least_rows), a + b - whole, -1.0)
    if not gain.shape[1]:
        return np.full(len(counts), -1), np.zeros(len(counts))
    at = gain.argmax(axis=1)
    best = gain[np.arange(len(counts)), at]
    return np.where(best > 1e-9, at, -1), best


STATE = "row long, label int, first int, bins binary"
CELLS = "node int, feature int, cell long, n long"
_CELLS = pa.schema([("node", pa.int32()), ("feature", pa.int32()), ("cell", pa.int64()), ("n", pa.int64())])
BEST = "node int, feature int, fold int, bin int, gain double, left_labels array<long>, labels array<long>"


def _state(rows: DataFrame, model: FoldForests, keys: list[str], train: Column) -> DataFrame:
    dates = F.array(*[F.lit(f.date).cast("date") for f in model.folds])
    day = F.to_date("bar_ts")
    first = F.size(F.filter(dates, lambda d: d <= day))
    chosen = rows.where(F.col(LABEL).isNotNull() & F.col("bar_ts").isNotNull() & train).select(
        F.xxhash64(*keys).alias("row"), F.col(LABEL).cast("int").alias("label"), first.alias("first"), *_as_doubles(model.columns)
    )
    edges = model.edges

    def cut(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], _binary(_cut(_features(batch, len(edges)), edges))], ["row", "label", "first", "bins"])

    return stage(chosen.where(F.col("first") < len(model.folds)).mapInArrow(cut, STATE), "folds")


def _walk(nodes: list[Node], root: int, bins: np.ndarray, wanted: set[int]):
    """(node, its rows) of the wanted nodes of a tree, each reached over the cuts of its folds."""
    open_nodes = [(root, np.arange(len(bins)))]
    while open_nodes:
        at, rows = open_nodes.pop()
        if not len(rows):
            continue
        if at in wanted:
            yield at, rows
        for (f, cut), (left, right) in nodes[at].cuts.items():
            goes_left = bins[rows, f] <= cut
            open_nodes += [(left, rows[goes_left]), (right, rows[~goes_left])]


def _level(state: DataFrame, model: FoldForests, active: dict[int, list[int]]) -> list:
    """Best cut of every active (node, fold), in one pass over the rows."""
    params, nodes, n_columns, n_folds, n_bins = model.params, model.nodes, len(model.columns), len(model.folds), model.params.bins
    wanted = set(active)
    roots = sorted({nodes[a].tree for a in active})

    def count(batches):
        for batch in batches:
            row, label, first = (batch.column(c).to_numpy() for c in ("row", "label", "first"))
            bins = _fixed(batch.column("bins"), np.uint8, n_columns)
            for tree in roots:
                times = weights(row, tree, params)
                found = {"node": [], "feature": [], "cell": [], "n": []}
                for at, rows in _walk(nodes, tree, bins, wanted):
                    for f in tried(nodes[at].key, n_columns, params):
                        cells = (first[rows].astype(np.int64) * n_bins + bins[rows, f]) * CLASSES + label[rows]
                        sums = np.bincount(cells, times[rows]).astype(np.int64)
                        there = np.flatnonzero(sums)
                        for name, values in (("node", np.full(len(there), at)), ("feature", np.full(len(there), f)), ("cell", there), ("n", sums[there])):
                            found[name].append(values)
                if found["node"]:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found[c.name]), c.type) for c in _CELLS], schema=_CELLS)

    def best(table):
        at, f = table["node"][0].as_py(), table["feature"][0].as_py()
        own = np.zeros(n_folds * n_bins * CLASSES, np.int64)
        own[table["cell"].to_numpy()] = table["n"].to_numpy()
        by_fold = np.cumsum(own.reshape(n_folds, n_bins, CLASSES), axis=0)[active[at]]
        cut, gain = best_cuts(by_fold, params)
        left = np.cumsum(by_fold, axis=1)[np.arange(len(by_fold)), np.maximum(cut, 0)]
        columns = [[at] * len(cut), [f] * len(cut), active[at], cut.tolist(), gain.tolist(), left.tolist(), by_fold.sum(axis=1).tolist()]
        kinds = [pa.int32()] * 4 + [pa.float64()] + [pa.list_(pa.int64())] * 2
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], [part.split()[0] for part in BEST.split(", ")])

    cells = state.mapInArrow(count, CELLS).groupBy("node", "feature", "cell").agg(F.sum("n").alias("n"))
    cuts = cells.groupBy("node", "feature").applyInArrow(best, BEST)
    # Of equal gains the first column wins; a column without a cut only tells the labels.
    order = F.struct(F.when(F.col("bin") >= 0, -F.col("gain")).otherwise(F.lit(float("inf"))).alias("loss"), "feature", "bin", "left_labels", "labels")
    return cuts.groupBy("node", "fold").agg(F.min(order).alias("best")).select("node", "fold", "best.*").collect()


def fit(
    rows: DataFrame, columns: list[str], keys: list[str], folds: list[Fold], params: Params = Params(),
    train: Column | None = None, edges: list[np.ndarray] | None = None,
) -> FoldForests:
    """The forest of every fold; ``rows`` has ``bar_ts``, the label column, and the numeric ``columns``.

    A fold trains on the rows of ``train`` before its date. ``edges`` are the cut points of each column, by default the quantiles of the first fold's
    rows, so that no later day shapes them. Rows without a label or a time are left out, missing values count as 0. A fold without rows has trees
    without counts, which know nothing. ``keys`` tell rows apart: rows with the same keys are in the same bootstrap samples.
    """
    train = F.lit(True) if train is None else F.coalesce(train, F.lit(False))
    folds = sorted(folds, key=lambda f: f.date)
    if not folds or not 2 <= params.bins <= 256:
        raise ValueError("at least one fold, and 2 to 256 bins")
    if edges is None:
        known = rows.where(F.col(LABEL).isNotNull() & train & folds[0].masks()["train"])
        edges = bin_edges(known, columns, params.bins)
    if any(len(e) >= params.bins for e in edges):
        raise ValueError("more cut points than bins")
    model = FoldForests(columns, edges, folds, params)
    model.nodes = [Node(k, _mixed(params.seed * 0x9E3779B97F4A7C15 + k * 977 + 13 & _MASK), 0) for k in range(params.trees)]
    state = _state(rows, model, keys, train)
    active = {k: list(range(len(folds))) for k in range(params.trees)}
    while active:
        found, active = _level(state, model, active), {}
        for cut in sorted(found, key=lambda r: (r["node"], r["fold"])):
            node, k = model.nodes[cut["node"]], cut["fold"]
            node.counts[k] = np.array(cut["labels"])
            if cut["bin"] < 0 or node.depth == params.depth:
                continue
            chosen = cut["feature"], cut["bin"]
            if chosen not in node.cuts:
                ends = len(model.nodes), len(model.nodes) + 1
                model.nodes += [Node(node.tree, child_key(node.key, *chosen, side), node.depth + 1) for side in (0, 1)]
                node.cuts[chosen] = ends
            node.cut_of[k] = chosen
            left = np.array(cut["left_labels"])
            for child, labels in zip(node.cuts[chosen], (left, node.counts[k] - left)):
                model.nodes[child].counts[k] = labels
                if node.depth + 1 < params.depth and (labels > 0).sum() > 1:
                    active.setdefault(child, []).append(k)
    return model


def probabilities(model: FoldForests, fold: int, bins: np.ndarray) -> np.ndarray:
    """Mean of the trees' label shares for each row."""
    total = np.zeros((len(bins), CLASSES))
    for tree in range(model.params.trees):
        open_nodes = [(tree, np.arange(len(bins)))]
        while open_nodes:
            at, rows = open_nodes.pop()
            node = model.nodes[at]
            if fold in node.cut_of:
                f, cut = node.cut_of[fold]
                goes_left = bins[rows, f] <= cut
                left, right = node.cuts[f, cut]
                open_nodes += [(left, rows[goes_left]), (right, rows[~goes_left])]
            elif fold in node.counts and node.counts[fold].sum():
                total[rows] += node.counts[fold] / node.counts[fold].sum()
            else:
                total[rows] += 1 / CLASSES
    return total / max(1, model.params.trees)


def evaluate_folds(model: FoldForests, rows: DataFrame, market_only: bool = True) -> DataFrame:
    """fold, split, rows, merror, mlogloss of every fold on its test sets, in one pass over the rows. Sets without rows have none."""
    n, dates = len(model.columns), [f.date for f in model.folds]
    names = [name for name in model.folds[0].masks(market_only) if name != "train"]
    masks = [F.coalesce(f.masks(market_only)[name], F.lit(False)) for f in model.folds for name in names]
    marks = F.array(*masks)
    marked = rows.where(F.col(LABEL).isNotNull()).select(F.col(LABEL).cast("int").alias("label"), marks.alias("marks"), *_as_doubles(model.columns))

    def score(batches):
        for batch in batches:
            label = batch.column("label").to_numpy()
            bins = _cut(_features(batch, n), model.edges)
            inside = batch.column("marks").flatten().to_numpy(zero_copy_only=False).reshape(len(label), len(dates), len(names))
            for k, date in enumerate(dates):
                tested = np.flatnonzero(inside[:, k].any(axis=1))
                if not len(tested):
                    continue
                wrong, loss = losses(probabilities(model, k, bins[tested]), label[tested])
                for i, name in enumerate(names):
                    own = inside[tested, k, i]
                    if own.any():
                        yield pa.RecordBatch.from_pylist([{"fold": date, "split": name, "n": int(own.sum()), "wrong": int(wrong[own].sum()), "loss": float(loss[own].sum())}])

    parts = marked.mapInArrow(score, "fold string, split string, n long, wrong long, loss double").groupBy("fold", "split")
    total = parts.agg(F.sum("n").alias("rows"), F.sum("wrong").alias("wrong"), F.sum("loss").alias("loss"))
    return total.select("fold", "split", "rows", (F.col("wrong") / F.col("rows")).alias("merror"), (F.col("loss") / F.col("rows")).alias("mlogloss"))


def tree_rows(model: FoldForests) -> list[tuple]:
    """(fold, tree, depth, place, column, cut, labels) of every fold's nodes; ``place`` in heap order, a leaf has no column."""
    out = []
    for k, fold in enumerate(model.folds):
        open_nodes = [(tree, 0) for tree in range(model.params.trees)]
        while open_nodes:
            at, place = open_nodes.pop()
            node = model.nodes[at]
            labels = node.counts.get(k, np.zeros(CLASSES, np.int64)).tolist()
            cut = node.cut_of.get(k)
            named = (model.columns[cut[0]], float(model.edges[cut[0]][cut[1]])) if cut else (None, None)
            out.append((fold.date, node.tree, node.depth, place, *named, labels))
            if cut:
                open_nodes += [(child, 2 * place + 1 + side) for side, child in enumerate(node.cuts[cut])]
    return sorted(out, key=lambda r: (r[0], r[1], r[3]))


def tree_table(model: FoldForests, like: DataFrame) -> DataFrame:
    return like.sparkSession.createDataFrame(tree_rows(model), "fold string, tree int, depth int, place int, feature string, cut double, labels array<long>")
