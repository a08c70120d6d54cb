"""Correlation analysis and classifier evaluation."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.plans.blocks import RowFeature, row_features

# -- correlation ----------------------------------------------------------------------------


def _correlation(a: str, b: str) -> Column:
    """Correlation over the rows where both are present; null when either is constant."""
    spread = F.stddev_pop(F.when(F.col(b).isNotNull(), F.col(a))) * F.stddev_pop(
        F.when(F.col(a).isNotNull(), F.col(b))
    )
    return F.try_divide(F.covar_pop(a, b), spread)


_MOMENTS = ["n", "si", "sj", "qi", "qj", "p"]


def _pair_sums(columns: list[str], by: list[str]):
    """Arrow batches, ordered by group, to one row of pairwise-complete sums per group met."""
    upper = np.triu_indices(len(columns))

    def sums_of(batch: pa.RecordBatch) -> list[np.ndarray]:
        x = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in columns])
        seen = (~np.isnan(x)).astype(float)
        x = np.nan_to_num(x)
        s, q = x.T @ seen, (x * x).T @ seen
        return [m[upper] for m in (seen.T @ seen, s, s.T, q, q.T, x.T @ x)]

    def row(keys: pa.Schema, key: dict, sums: list[np.ndarray]) -> pa.RecordBatch:
        schema = pa.schema([*keys, *[(m, pa.list_(pa.float64())) for m in _MOMENTS]])
        return pa.RecordBatch.from_pylist([key | {m: v.tolist() for m, v in zip(_MOMENTS, sums)}], schema=schema)

    def partial(batches):
        open_key, open_sums = None, None
        for batch in batches:
            keys = pa.schema([batch.schema.field(b) for b in by])
            cuts = np.zeros(max(batch.num_rows - 1, 0), bool)
            for b in by:
                codes = batch.column(b).dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
                cuts |= codes[1:] != codes[:-1]
            edges = [0, *(np.flatnonzero(cuts) + 1).tolist(), batch.num_rows]
            for start, end in zip(edges, edges[1:]):
                if start == end:
                    continue
                part = batch.slice(start, end - start)
                key = {b: part.column(b)[0].as_py() for b in by}
                sums = sums_of(part)
                if key == open_key:
                    open_sums = [a + b for a, b in zip(open_sums, sums)]
                    continue
                if open_key is not None:
                    yield row(keys, open_key, open_sums)
                open_key, open_sums = key, sums
        if open_key is not None:
            yield row(keys, open_key, open_sums)

    return partial


#: Rows of a group that are summed together; a larger group is dealt in as many parts as it needs.
PART_ROWS = 65_536


def correlations(df: DataFrame, columns: list[str], by: list[str] = ("symbol",)) -> DataFrame:
    """Pairwise-complete correlation matrix in long form ``(by..., from_col, to_col, correlation)``.

    Every column is centred on its mean in the group, so groups far from each other lose no digits. Rows
    are dealt by group and a hash of values and keys, in as many parts as the group's size asks for, and arrive in order of group: a task holds
    one matrix of sums at a time and a group with most rows is spread over many. Null when a column is constant over the rows of a pair.
    """
    by = list(by)
    # Keys tell rows with equal values apart.
    keys = [k for k in ("symbol", "bar_ts") if k in df.columns and k not in columns]
    x = df.select(*by, *([F.xxhash64(*columns, *keys).alias("_hash")] if by else []), *[F.col(c).cast("double").alias(c) for c in columns])

    def off_mean(c: str) -> Column:
        off, mean = F.col(c) - F.col(f"_mean_{c}"), F.abs(f"_mean_{c}")
        # What is left of a constant after rounding of its mean is nothing.
        return F.when(F.abs(off) <= mean * F.lit(2.0**-50), F.lit(0.0)).otherwise(off).alias(c)

    parts = F.ceil(F.count(F.lit(1)) / PART_ROWS).alias("_parts")
    means = x.groupBy(*by).agg(*([parts] if by else []), *[F.avg(c).alias(f"_mean_{c}") for c in columns])
    if by:
        keyed = means.select(*[F.col(b).alias(f"_by_{b}") for b in by], *means.columns[len(by) :])
        same = [F.col(b).eqNullSafe(F.col(f"_by_{b}")) for b in by]
        centred = x.join(keyed, same).select(*by, F.pmod("_hash", "_parts").alias("_part"), *[off_mean(c) for c in columns])
        centred = centred.repartition(*by, "_part").sortWithinPartitions(*by).drop("_part")
    else:
        # The means of all rows are one row.
        centred = x.join(F.broadcast(means)).select(*[off_mean(c) for c in columns])
    key_fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in x.select(*by).schema.fields)
    partial = centred.mapInArrow(_pair_sums(columns, by), key_fields + ", ".join(f"{m} array<double>" for m in _MOMENTS))
    order = [(i, j) for i in range(len(columns)) for j in range(i, len(columns))]
    places = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in order])
    cells = F.arrays_zip(places.alias("at"), *_MOMENTS)
    pairs = (
        partial.select(*by, F.explode(cells).alias("c"))
        .groupBy(*by, F.col("c.at.i").alias("i"), F.col("c.at.j").alias("j"))
        .agg(*[F.sum(f"c.{m}").alias(m) for m in _MOMENTS])
    )
    spread = "sqrt(greatest((qi - si * si / n) * (qj - sj * sj / n), 0D))"
    # A constant column leaves only rounding noise in its sum of squares.
    flat = "least((qi - si * si / n) / qi, (qj - sj * sj / n) / qj) <= 1e-14"
    value = f"CASE WHEN n = 0 OR qi = 0 OR qj = 0 OR {flat} THEN NULL ELSE (p - si * sj / n) / {spread} END"
    names = "array(" + ", ".join(f"'{c}'" for c in columns) + ")"
    here, there = "named_struct('a', i, 'b', j)", "named_struct('a', j, 'b', i)"
    both = f"inline(if(i = j, array({here}), array({here}, {there}))) AS (a, b)"
    return (
        pairs.selectExpr(*by, "i", "j", f"{value} AS correlation")
        .selectExpr(*by, both, "correlation")
        .selectExpr(*by, f"{names}[int(a)] AS from_col", f"{names}[int(b)] AS to_col", "correlation")
    )


def ranked_pairs(matrix: DataFrame) -> DataFrame:
    """Each unordered pair once, strongest first and undefined ones last, without perfect ones.

    Perfect means 1 up to the last bits of the sums.
    """
    r = F.col("correlation")
    kept = r.isNull() | (r < 1 - 1e-12)
    return matrix.where((F.col("from_col") < F.col("to_col")) & kept).orderBy(
        F.desc_nulls_last("correlation"), "from_col", "to_col"
    )


def uncorrelated_columns(
    df: DataFrame, columns: list[str], threshold: float = 0.95
) -> list[str]:
    """Columns that no later kept column is strongly correlated with, last column first.

    Spark returns the strong pairs only, by the columns' places, so what reaches the driver is at most
    a pair for each two columns, whatever the number of rows.
    """
    place = F.array_position(F.array(*[F.lit(c) for c in columns]), F.col("from_col")).alias("place")
    strong = correlations(df, columns, by=[]).where(
        (F.abs("correlation") > threshold) & (F.col("from_col") != F.col("to_col"))
    )
    partners: dict[str, set[str]] = {}
    for pair in strong.select(place, "from_col", "to_col").orderBy("place").collect():
        partners.setdefault(pair["from_col"], set()).add(pair["to_col"])
    kept: list[str] = []
    for column in columns[::-1]:
        if partners.get(column, set()).isdisjoint(kept):
            kept.append(column)
    return kept


def lag_correlation(df: DataFrame, column: str, grain: str, lag: int = 1) -> DataFrame:
    """Autocorrelation of a column per symbol."""
    step = RowFeature(lag, lambda w: {"lagged": F.lag(column, lag).over(w)})
    rows = row_features(df, [step], grain)
    return rows.groupBy("symbol").agg(_correlation(column, "lagged").alias("autocorrelation"))


# -- classification -------------------------------------------------------------------------


def class_counts(df: DataFrame, label: str = "category", by: list[str] = ()) -> DataFrame:
    return df.groupBy(*by, label).agg(F.count(F.lit(1)).alias("rows"))


def confusion_matrix(df: DataFrame, classes: list) -> DataFrame:
    """Rows: actual class; columns ``pred_{class}``."""
    return df.groupBy("actual").agg(
        *[F.count_if(F.col("pred") == c).alias(f"pred_{c}") for c in classes]
    )


def class_tallies(df: DataFrame, classes: list) -> DataFrame:
    """Per class: true positives, rows predicted, rows actual. One pass, one output row per class."""
    tallies = []
    for c in classes:
        actual, pred = F.col("actual") == c, F.col("pred") == c
        tallies += [
            F.count_if(actual & pred).alias(f"_tp{c}"),
            F.count_if(pred).alias(f"_pp{c}"),
            F.count_if(actual).alias(f"_ap{c}"),
        ]
    cells = F.array(
        *[
            F.struct(
                F.lit(c).alias("label"),
                F.col(f"_tp{c}").alias("hits"),
                F.col(f"_pp{c}").alias("predicted"),
                F.col(f"_ap{c}").alias("support"),
            )
            for c in classes
        ]
    )
    return df.agg(*tallies).select(F.inline(cells)).where("predicted + support > 0")


def _ratio(top: Column, bottom: Column) -> Column:
    """Division where an empty denominator gives 0."""
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def _scored(tallies: DataFrame) -> DataFrame:
    hits, predicted, support = F.col("hits"), F.col("predicted"), F.col("support")
    return tallies.withColumns(
        {
            "precision": _ratio(hits, predicted),
            "recall": _ratio(hits, support),
            "f1": _ratio(2 * hits, predicted + support),
        }
    )


def per_class_scores(df: DataFrame, classes: list) -> DataFrame:
    return _scored(class_tallies(df, classes)).select("label", "precision", "recall", "f1", "support")


def summary_scores(df: DataFrame, classes: list) -> DataFrame:
    """One row: accuracy, balanced accuracy, and micro / macro / weighted precision, recall, F1."""
    scored = _scored(class_tallies(df, classes))
    hits, rows = F.sum("hits"), F.sum("support")
    predicted = F.sum("predicted")
    aggs = [
        _ratio(hits, rows).alias("accuracy"),
        F.avg(F.when(F.col("support") > 0, F.col("recall"))).alias("balanced_accuracy"),
        _ratio(hits, predicted).alias("micro_precision"),
        _ratio(hits, rows).alias("micro_recall"),
        _ratio(2 * hits, predicted + rows).alias("micro_f1"),
    ]
    for m in ("precision", "recall", "f1"):
        aggs.append(F.avg(m).alias(f"macro_{m}"))
        aggs.append(_ratio(F.sum(F.col(m) * F.col("support")), rows).alias(f"weighted_{m}"))
    return scored.agg(*aggs)


def classification_report(df: DataFrame, classes: list) -> DataFrame:
    """Long table ``(label, precision, recall, f1, support)`` with accuracy and average rows."""
    scored = _scored(class_tallies(df, classes))
    per_class = scored.select(
        F.col("label").cast("string").alias("label"), "precision", "recall", "f1", "support"
    )
    rows = F.sum("support")
    accuracy = _ratio(F.sum("hits"), rows)
    lines = [
        F.struct(
            F.lit("accuracy").alias("label"),
            F.col("_acc").alias("precision"),
            F.col("_acc").alias("recall"),
            F.col("_acc").alias("f1"),
            F.col("_rows").alias("support"),
        )
    ]
    aggs = [accuracy.alias("_acc"), rows.alias("_rows")]
    for kind in ("macro", "weighted"):
        for m in ("precision", "recall", "f1"):
            value = F.avg(m) if kind == "macro" else _ratio(F.sum(F.col(m) * F.col("support")), rows)
            aggs.append(value.alias(f"_{kind}_{m}"))
        lines.append(
            F.struct(
                F.lit(f"{kind} avg").alias("label"),
                *[F.col(f"_{kind}_{m}").alias(m) for m in ("precision", "recall", "f1")],
                F.col("_rows").alias("support"),
            )
        )
    averages = scored.agg(*aggs).select(F.inline(F.array(*lines)))
    return per_class.unionByName(averages)


def losses(df: DataFrame, probabilities: list[str], by: list[str] = ("eval_set",)) -> DataFrame:
    """Error rate and log loss per evaluation set; ``actual`` holds the class position."""
    p_actual = F.array(*probabilities)[F.col("actual").cast("int")]
    return df.groupBy(*by).agg(
        F.avg((F.col("pred") != F.col("actual")).cast("double")).alias("merror"),
        (-F.avg(F.log(F.greatest(p_actual, F.lit(1e-15))))).alias("mlogloss"),
    )


# -- decisions from probabilities -----------------------------------------------------------


def confident_category(probabilities: dict[str, str], threshold: float, default: str = "C") -> Column:
    """First class whose probability exceeds the threshold, else the default."""
    decision = F.lit(default)
    for label, column in reversed(list(probabilities.items())):
        decision = F.when(F.col(column) > threshold, label).otherwise(decision)
    return decision


def threshold_argmax(probabilities: list[str], threshold: Column) -> Column:
    """Position of the first probability at or above the threshold; 0 when there is none."""
    decision = F.lit(0)
    for i, column in reversed(list(enumerate(probabilities))):
        decision = F.when(F.col(column) >= threshold, i).otherwise(decision)
    return decision


def argmax(probabilities: list[str]) -> Column:
    """Position of the largest probability, the first one on ties."""
    p = F.array(*probabilities)
    return (F.array_position(p, F.array_max(p)) - 1).cast("int")


def threshold_confusion(
    df: DataFrame, probabilities: list[str], thresholds: list[float]
) -> DataFrame:
    """Confusion counts of :func:`threshold_argmax` for each threshold, in one pass.

    Counts are taken per threshold as separate aggregates, so rows are not multiplied.
    """
    classes = range(len(probabilities))
    aggs, cells = [], []
    for k, t in enumerate(thresholds):
        pred = threshold_argmax(probabilities, F.lit(t))
        for c in classes:
            aggs.append(F.count_if(pred == c).alias(f"_n{k}_{c}"))
        cells.append(
            F.struct(
                F.lit(t).alias("threshold"),
                *[F.col(f"_n{k}_{c}").alias(f"pred_{c}") for c in classes],
            )
        )
    return df.groupBy("actual").agg(*aggs).select("actual", F.inline(F.array(*cells)))


# -- importances ----------------------------------------------------------------------------


def strongest(scores: DataFrame, n: int = 40) -> DataFrame:
    return scores.orderBy(F.desc("score"), "feature").limit(n)


def weakest(scores: DataFrame, n: int = 40) -> DataFrame:
    return scores.orderBy("score", "feature").limit(n)

