"""Multiclass gradient boosting on quantile bins, with loss curves and early stopping.

Rows are binned once and stored as a few bytes each. A round grows a tree per class, level by level, all classes in one pass: tasks
sum gradients and curvatures by (class, node, feature, bin), the sums of a feature meet in one group, which finds its best cut,
and only a row per (class, node, feature) comes to the driver. Gradients are whole numbers of 2^-30, so sums don't depend on
their order: the same rows give the same trees however they are partitioned.

The pass of a round's first level also adds up the losses of every evaluation set after the rounds before, so the
curves and the rule that stops the boosting cost no pass of their own. Every few rounds the margins are stored again beside the bins; in
between, a pass applies only the trees that are newer. A lost executor repeats tasks of one pass.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators.evaluate import argmax
from tickloom.operators.training import CLASSES, LABEL, SEED, TREES
from tickloom.sources.storage import stage

SCALE = float(1 << 30)
#: Rounds after which margins are stored anew.
STORE_EVERY = 10
#: Partial sums of one feature that meet in one group at once.
TOGETHER = 1000


@dataclass(frozen=True)
class Params:
    """The defaults of rounds, depth, rate, weights and seed are fixed values."""

    rounds: int = TREES
    depth: int = 6
    rate: float = 0.3
    l2: float = 1.0
    least_curvature: float = 1.0
    bins: int = 64
    #: Share of the training rows in each round, picked by a hash of row and round.
    subsample: float = 1.0
    seed: int = SEED
    #: Rounds without a lower loss after which boosting stops, if a set to stop on is named.
    patience: int = 10


@dataclass
class Tree:
    """Nodes in heap order: children of i are 2i + 1 and 2i + 2. A node without a feature (-1) is a leaf with a value."""

    feature: np.ndarray
    bin: np.ndarray
    value: np.ndarray
    gain: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> Tree:
        n = (2 << depth) - 1
        return cls(np.full(n, -1, np.int32), np.zeros(n, np.int32), np.zeros(n), np.zeros(n))

    def nodes(self, bins: np.ndarray) -> np.ndarray:
        """Node that each row has reached."""
        at = np.zeros(len(bins), np.int64)
        for _ in range(len(self.feature).bit_length() - 1):
            f = self.feature[at]
            inner = np.flatnonzero(f >= 0)
            if not len(inner):
                break
            right = bins[inner, f[inner]] > self.bin[at[inner]]
            at[inner] = 2 * at[inner] + 1 + right
        return at


@dataclass
class Boosted:
    """A fitted model: cut points of each column, and a tree per class of each round."""

    columns: list[str]
    edges: list[np.ndarray]
    params: Params
    trees: list[list[Tree]] = field(default_factory=list)
    #: Rows (round, eval_set, rows, merror, mlogloss) of the fit, if evaluation sets were named.
    curve: list[tuple] = field(default_factory=list)


def bin_edges(rows: DataFrame, columns: list[str], bins: int) -> list[np.ndarray]:
    """Cut points of each column between its quantiles; a missing value counts as 0. One pass, a row to the driver."""
    shares = [k / bins for k in range(1, bins)]
    values = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns]
    found = rows.agg(*[F.percentile_approx(v, shares, 10_000).alias(f"_{i}") for i, v in enumerate(values)]).first()
    return [np.unique(np.array(found[i] or [], np.float64)) for i in range(len(columns))]


STATE = "row long, label int, train boolean, sets long, bins binary, margins binary"


def _fixed(column: pa.Array, kind, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width)


def _binary(values: np.ndarray) -> pa.Array:
    """Each row of a table of numbers as one binary value."""
    data = np.ascontiguousarray(values)
    ends = np.arange(len(data) + 1, dtype=np.int32) * (data.itemsize * data.shape[1])
    return pa.Array.from_buffers(pa.binary(), len(data), [None, pa.py_buffer(ends), pa.py_buffer(data.tobytes())])


def _cut(values: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """Bin of each value: the number of cut points below it."""
    out = np.empty(values.shape, np.uint8)
    for i, e in enumerate(edges):
        out[:, i] = np.searchsorted(e, values[:, i], side="left")
    return out


def _features(batch: pa.RecordBatch, n: int) -> np.ndarray:
    columns = [batch.column(f"_f{i}").fill_null(0.0).to_numpy(zero_copy_only=False) for i in range(n)]
    return np.column_stack(columns) if columns else np.zeros((batch.num_rows, 0))


def _as_doubles(columns: list[str]) -> list[Column]:
    return [F.col(c).cast("double").alias(f"_f{i}") for i, c in enumerate(columns)]


def _state(rows: DataFrame, model: Boosted, keys: list[str], train: Column, sets: list[Column]) -> DataFrame:
    """Binned rows with margins of 0; a row without a label trains and counts nowhere."""
    known = F.col(LABEL).isNotNull()
    bits = sum((F.when(known & c, F.lit(1 << k)).otherwise(0) for k, c in enumerate(sets)), F.lit(0)).cast("long")
    chosen = rows.select(
        F.xxhash64(*keys).alias("row"), F.coalesce(F.col(LABEL), F.lit(0)).cast("int").alias("label"),
        F.coalesce(known & train, F.lit(False)).alias("train"), bits.alias("sets"), *_as_doubles(model.columns),
    )
    edges = model.edges

    def cut(batches):
        for batch in batches:
            bins = _cut(_features(batch, len(edges)), edges)
            margins = np.zeros((batch.num_rows, CLASSES))
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], _binary(bins), _binary(margins)], ["row", "label", "train", "sets", "bins", "margins"])

    return stage(chosen.where("train OR sets > 0").mapInArrow(cut, STATE), "boosting")


def _apply(trees: list[list[Tree]], bins: np.ndarray, margins: np.ndarray) -> np.ndarray:
    """Margins after more rounds."""
    out = margins.copy()
    for level in trees:
        for k, tree in enumerate(level):
            out[:, k] += tree.value[tree.nodes(bins)]
    return out


def _softmax(margins: np.ndarray) -> np.ndarray:
    e = np.exp(margins - margins.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def gradients(p: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients and curvatures of the log loss by class, as whole numbers of 1 / SCALE."""
    hit = np.zeros_like(p)
    hit[np.arange(len(label)), label] = 1.0
    return np.rint((p - hit) * SCALE).astype(np.int64), np.rint(np.maximum(2 * p * (1 - p), 1e-16) * SCALE).astype(np.int64)


def picked(row: np.ndarray, number: int, params: Params) -> np.ndarray:
    """Whether rows are in the sample of a round."""
    if params.subsample >= 1:
        return np.ones(len(row), bool)
    x = row.view(np.uint64) ^ np.uint64((params.seed * 0x9E3779B97F4A7C15 + number * 0xC2B2AE3D27D4EB4F) % (1 << 64))
    for _ in range(2):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return (x >> np.uint64(11)).astype(np.float64) / float(1 << 53) < params.subsample


def losses(p: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Wrong answers and log losses of rows."""
    return np.argmax(p, axis=1) != label, -np.log(np.maximum(p[np.arange(len(label)), label], 1e-15))


SUMS = "klass int, node int, feature int, part int, g binary, h binary"
_SUMS = pa.schema([("klass", pa.int32()), ("node", pa.int32()), ("feature", pa.int32()), ("part", pa.int32()), ("g", pa.binary()), ("h", pa.binary())])
CUTS = "klass int, node int, feature int, bin int, gain double, g_left long, h_left long, g long, h long"
#: Class of the rows that carry losses; their node is the evaluation set.
LOSS = -1


def _pass(state: DataFrame, newer: list[list[Tree]], growing: list[Tree] | None, active: list[tuple[int, int]], number: int, n_sets: int, model: Boosted):
    """Sums of all tasks: histograms of the active (class, node) pairs, and the losses of the sets if ``n_sets``."""
    params, n_features, n_bins = model.params, len(model.columns), model.params.bins
    place = {pair: k for k, pair in enumerate(active)}

    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        g_sums, h_sums = (np.zeros((len(active), n_features, n_bins), np.int64) for _ in range(2))
        lost = np.zeros((n_sets, 3))
        for batch in batches:
            label = batch.column("label").to_numpy()
            bins = _fixed(batch.column("bins"), np.uint8, n_features)
            p = _softmax(_apply(newer, bins, _fixed(batch.column("margins"), np.float64, CLASSES)))
            sets = batch.column("sets").to_numpy()
            if n_sets:
                wrong, loss = losses(p, label)
                for k in range(n_sets):
                    inside = (sets >> k) & 1 == 1
                    lost[k] += inside.sum(), wrong[inside].sum(), loss[inside].sum()
            if not active:
                continue
            chosen = batch.column("train").to_numpy(zero_copy_only=False) & picked(batch.column("row").to_numpy(), number, params)
            bins = bins[chosen]
            g, h = gradients(p[chosen], label[chosen])
            for klass, tree in enumerate(growing):
                slot = np.full(len(tree.feature), -1)
                for (c, node), k in place.items():
                    if c == klass:
                        slot[node] = k
                at = slot[tree.nodes(bins)]
                inside = np.flatnonzero(at >= 0)
                for f in range(n_features if len(inside) else 0):
                    index = at[inside] * n_bins + bins[inside, f]
                    for sums, values in ((g_sums, g), (h_sums, h)):  # whole numbers below 2^53 in a batch: exact
                        sums[:, f] += np.bincount(index, values[inside, klass], sums[:, f].size).astype(np.int64).reshape(-1, n_bins)
        rows = [
            {"klass": klass, "node": node, "feature": f, "part": part, "g": g_sums[k, f].tobytes(), "h": h_sums[k, f].tobytes()}
            for (klass, node), k in place.items()
            if h_sums[k].any()
            for f in range(n_features)
        ]
        rows += [{"klass": LOSS, "node": k, "feature": 0, "part": part, "g": lost[k].tobytes(), "h": b""} for k in range(n_sets)]
        yield pa.RecordBatch.from_pylist(rows, _SUMS)

    return state.mapInArrow(run, SUMS)


def _added(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    kind = np.float64 if table["klass"][0].as_py() == LOSS else np.int64
    g, h = (np.sum([np.frombuffer(x, kind if x else np.int64) for x in table[c].to_pylist()], axis=0) for c in ("g", "h"))
    return g, h


def best_cut(g: np.ndarray, h: np.ndarray, params: Params) -> tuple[int, float, int, int]:
    """(bin, gain, sum of g, sum of h) of the left side of a feature's best cut; bin -1 if none gains."""
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    right_g, right_h = g.sum() - left_g, h.sum() - left_h

    def score(a, b):
        return (a / SCALE) ** 2 / (b / SCALE + params.l2)

    least = params.least_curvature * SCALE
    gains = np.where((left_h >= least) & (right_h >= least), score(left_g, left_h) + score(right_g, right_h) - score(g.sum(), h.sum()), -np.inf)
    at = int(np.argmax(gains)) if len(gains) else -1
    if at < 0 or not gains[at] > 1e-6:
        return -1, 0.0, 0, 0
    return at, float(gains[at]), int(left_g[at]), int(left_h[at])


def _cuts(sums: DataFrame, params: Params, tasks: int) -> list:
    """Best cut of every (class, node, feature), and sums of losses: a row for each comes to the driver."""
    keys = ["klass", "node", "feature"]
    if tasks > TOGETHER:  # in two steps

        def merge(table):
            g, h = _added(table)
            return pa.Table.from_pylist([{k: table[k][0].as_py() for k in (*keys, "part")} | {"g": g.tobytes(), "h": h.tobytes()}], _SUMS)

        sums = sums.withColumn("part", F.col("part") % 64).groupBy(*keys, "part").applyInArrow(merge, SUMS)
    kinds = [pa.int32()] * 4 + [pa.float64()] + [pa.int64()] * 4
    names = [part.split()[0] for part in CUTS.split(", ")]

    def best(table):
        g, h = _added(table)
        row = [table[k][0].as_py() for k in keys]
        if row[0] == LOSS:
            row += [-1, float(g[2]), int(g[0]), int(g[1]), 0, 0]
        else:
            row += [*best_cut(g, h, params), int(g.sum()), int(h.sum())]
        return pa.table([pa.array([v], t) for v, t in zip(row, kinds)], names)

    return sums.groupBy(*keys).applyInArrow(best, CUTS).collect()


def fit(
    rows: DataFrame,
    columns: list[str],
    keys: list[str],
    params: Params = Params(),
    train: Column | None = None,
    sets: dict[str, Column] | None = None,
    stop_on: str | None = None,
) -> Boosted:
    """Boosted trees of the numeric ``columns`` for the label column.

    ``train`` picks the rows to learn from (default: all), ``sets`` names conditions whose losses are followed round by round,
    whether or not their rows train. With ``stop_on`` boosting ends once that set's log loss hasn't fallen for
    ``patience`` rounds, and the rounds after the lowest loss are dropped. Rows without a label are left out; missing values
    count as 0. Of equal gains the first feature and the lowest cut win.
    """
    train = F.lit(True) if train is None else train
    names = list(sets or {})
    if stop_on is not None and stop_on not in names:
        raise ValueError(f"{stop_on} is none of the evaluation sets")
    if not 2 <= params.bins <= 256:
        raise ValueError("2 to 256 bins")
    model = Boosted(columns, bin_edges(rows.where(train & F.col(LABEL).isNotNull()), columns, params.bins), params)
    state = _state(rows, model, keys, train, [sets[n] for n in names])
    stored_at, best_round, lowest = 0, 0, np.inf
    tasks = state.rdd.getNumPartitions()

    def follow(found: list) -> bool:
        """Writes down the losses after the rounds so far; whether to stop."""
        nonlocal best_round, lowest
        for cut in found:
            if cut["klass"] == LOSS and cut["g_left"]:
                name, n = names[cut["node"]], cut["g_left"]
                model.curve.append((len(model.trees), name, n, cut["h_left"] / n, cut["gain"] / n))
                if name == stop_on and cut["gain"] / n < lowest:
                    best_round, lowest = len(model.trees), cut["gain"] / n
        return stop_on is not None and len(model.trees) - best_round >= params.patience

    for number in range(params.rounds):
        growing = [Tree.empty(params.depth) for _ in range(CLASSES)]
        active = [(k, 0) for k in range(CLASSES)]
        newer = model.trees[stored_at:]
        for level in range(params.depth + 1):
            found = _cuts(_pass(state, newer, growing, active, number, len(names) if level == 0 else 0, model), params, tasks)
            if level == 0 and number and follow(found):
                break
            active = _split(growing, found, params, last=level == params.depth)
            if not active:
                break
        if stop_on is not None and len(model.trees) - best_round >= params.patience and number:
            break
        model.trees.append(growing)
        if len(model.trees) - stored_at == STORE_EVERY and number + 1 < params.rounds:
            state, stored_at = _stored_margins(state, model.trees[stored_at:], len(columns)), len(model.trees)
    else:
        if names:
            follow(_cuts(_pass(state, model.trees[stored_at:], None, [], params.rounds, len(names), model), params, tasks))
    if stop_on is not None:
        del model.trees[best_round:]
    model.curve.sort(key=lambda r: (r[0], names.index(r[1])))
    return model


def _split(growing: list[Tree], found: list, params: Params, last: bool) -> list[tuple[int, int]]:
    """Gives each active node its best cut or its value; returns the nodes of the next level."""
    nodes: dict[tuple[int, int], list] = {}
    for cut in found:
        if cut["klass"] != LOSS:
            nodes.setdefault((cut["klass"], cut["node"]), []).append(cut)
    active = []
    for (klass, node), cuts in sorted(nodes.items()):
        tree = growing[klass]
        best = min((c for c in cuts if c["bin"] >= 0), key=lambda c: (-c["gain"], c["feature"]), default=None)
        if last or best is None:
            tree.value[node] = -params.rate * (cuts[0]["g"] / SCALE) / (cuts[0]["h"] / SCALE + params.l2)
            continue
        tree.feature[node], tree.bin[node], tree.gain[node] = best["feature"], best["bin"], best["gain"]
        active += [(klass, 2 * node + 1), (klass, 2 * node + 2)]
    return active


def _stored_margins(state: DataFrame, newer: list[list[Tree]], n_features: int) -> DataFrame:
    def add(batches):
        for batch in batches:
            margins = _apply(newer, _fixed(batch.column("bins"), np.uint8, n_features), _fixed(batch.column("margins"), np.float64, CLASSES))
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], _binary(margins)], batch.schema.names)

    return stage(state.mapInArrow(add, STATE), "boosting")


# -- use ------------------------------------------------------------------------------------


def class_probabilities(model: Boosted, rows: DataFrame) -> DataFrame:
    """Adds ``p0, p1, p2`` and ``pred``."""
    names = [f"p{k}" for k in range(CLASSES)]
    kept = rows.columns
    fields = [*rows.schema.fields]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields] + [f"{n} double" for n in names])
    columns, edges, trees = model.columns, model.edges, model.trees

    def score(batches):
        for batch in batches:
            bins = _cut(_features(batch, len(columns)), edges)
            p = _softmax(_apply(trees, bins, np.zeros((batch.num_rows, CLASSES))))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *(pa.array(p[:, k]) for k in range(CLASSES))], [*kept, *names])

    return rows.select("*", *_as_doubles(columns)).mapInArrow(score, schema).withColumn("pred", argmax(names))


def loss_curves(model: Boosted, rows: DataFrame, sets: dict[str, Column]) -> DataFrame:
    """round, eval_set, rows, merror, mlogloss after each round of a finished model, in one pass over the rows."""
    columns, edges, trees, names = model.columns, model.edges, model.trees, list(sets)
    known = F.col(LABEL).isNotNull()
    marked = rows.where(known).select(F.col(LABEL).cast("int").alias("_label"), *[F.coalesce(sets[n], F.lit(False)).alias(f"_s{k}") for k, n in enumerate(names)], *_as_doubles(columns))

    def follow(batches):
        sums = np.zeros((len(trees), len(names), 3))
        for batch in batches:
            bins, label = _cut(_features(batch, len(columns)), edges), batch.column("_label").to_numpy()
            inside = [batch.column(f"_s{k}").to_numpy(zero_copy_only=False) for k in range(len(names))]
            margins = np.zeros((batch.num_rows, CLASSES))
            for number in range(len(trees)):
                margins = _apply(trees[number : number + 1], bins, margins)
                wrong, loss = losses(_softmax(margins), label)
                for k, mask in enumerate(inside):
                    sums[number, k] += mask.sum(), wrong[mask].sum(), loss[mask].sum()
        for number in range(len(trees)):
            for k, name in enumerate(names):
                n, wrong, loss = sums[number, k]
                yield pa.RecordBatch.from_pylist([{"round": number + 1, "eval_set": name, "n": int(n), "wrong": int(wrong), "loss": loss}])

    parts = marked.mapInArrow(follow, "round long, eval_set string, n long, wrong long, loss double").groupBy("round", "eval_set")
    total = parts.agg(F.sum("n").alias("rows"), F.sum("wrong").alias("wrong"), F.sum("loss").alias("loss")).where("rows > 0")
    return total.select("round", "eval_set", "rows", (F.col("wrong") / F.col("rows")).alias("merror"), (F.col("loss") / F.col("rows")).alias("mlogloss"))


def importances(model: Boosted, spark: SparkSession) -> DataFrame:
    """(feature, score): the mean gain of a feature's cuts, scaled to add up to 1."""
    total, n = np.zeros(len(model.columns)), np.zeros(len(model.columns))
    for level in model.trees:
        for tree in level:
            inner = tree.feature >= 0
            np.add.at(total, tree.feature[inner], tree.gain[inner])
            np.add.at(n, tree.feature[inner], 1)
    mean = np.divide(total, n, out=np.zeros_like(total), where=n > 0)
    scores = mean / mean.sum() if mean.sum() else mean
    return spark.createDataFrame(list(zip(model.columns, scores.tolist())), "feature string, score double")


def model_table(model: Boosted, spark: SparkSession) -> DataFrame:
    """A row per node: round, class, node, its column and cut (value at most), or its value."""
    rows = []
    for number, level in enumerate(model.trees):
        for klass, tree in enumerate(level):
            for node in np.flatnonzero((tree.feature >= 0) | (tree.value != 0)).tolist():
                f = int(tree.feature[node])
                inner = f >= 0
                cut = (model.columns[f], float(model.edges[f][tree.bin[node]])) if inner else (None, None)
                rows.append((number + 1, klass, node, *cut, None if inner else float(tree.value[node]), float(tree.gain[node])))
    return spark.createDataFrame(rows, "round int, klass int, node int, feature string, cut double, value double, gain double")
