"""Unbounded recurrences over a series: exponential averages, running totals, last-seen values.

An exponential average is a chain of affine steps ``y <- m*y + b``. Steps compose, so every chunk
of a series (see :mod:`tickloom.plans.blocks`) is reduced to one small summary, the summaries are
composed in order, and each chunk gets the average that enters it. Nulls follow the usual
unadjusted rule: leading nulls stay null, a null row repeats the last average, and the old weight
keeps decaying over the gap.

Sizes: a chunk holds at most 1,440 rows, 64 chunks form a span, and a series has one summary per
span. All three levels have a fixed bound given by the calendar, so no task ever holds a series.

The rows of one chunk are averaged with Arrow and pandas: a sweep adds hundreds of columns, and
as many window aggregates cost about ten times more than the same work on Arrow columns.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.plans.blocks import SYMBOL, TS, chunk_key

CHUNKS_PER_SPAN = 64


@dataclass(frozen=True)
class Ewm:
    """One exponential average: ``y = (1-alpha)*y + alpha*x``, unadjusted."""

    source: str
    alpha: float
    name: str
    min_periods: int = 0


def span_alpha(span: int) -> float:
    return 2.0 / (span + 1.0)


# Summary of a run of rows, one struct per average:
#   n rows, obs of them with a value; lead: 1-based place of the first value x; trail: rows after
#   the last value; the run turns the average y at x into p*y + q. Without a value, x is null.
# Composition of two neighbouring runs: the weight of the old average decays over the nulls between.
_COMPOSE = """zip_with({left}, {right}, (l, r) -> named_struct(
  'a', l.a,
  'n', l.n + r.n,
  'obs', l.obs + r.obs,
  'lead', if(l.x IS NULL, l.n + r.lead, l.lead),
  'x', coalesce(l.x, r.x),
  'p', if(l.x IS NULL OR r.x IS NULL, coalesce(l.p, r.p),
    r.p * l.p * power(1D - l.a, l.trail + r.lead) / (power(1D - l.a, l.trail + r.lead) + l.a)),
  'q', if(l.x IS NULL OR r.x IS NULL, coalesce(l.q, r.q),
    r.q + r.p * (power(1D - l.a, l.trail + r.lead) * l.q + l.a * r.x)
      / (power(1D - l.a, l.trail + r.lead) + l.a)),
  'trail', if(r.x IS NULL, l.trail + r.n, r.trail)))"""


def _compose(left: str, right: str) -> str:
    return _COMPOSE.format(left=left, right=right)


def _empty(specs: list[Ewm]) -> str:
    runs = [
        f"named_struct('a', {s.alpha!r}D, 'n', 0L, 'obs', 0L, 'lead', 0L, 'x', double(null), "
        "'p', double(null), 'q', double(null), 'trail', 0L)"
        for s in specs
    ]
    return f"array({', '.join(runs)})"


def _prefixes(entries: str, start: str, keys: list[str]) -> str:
    """Array of ``(keys..., state)``: the summary of everything before each entry."""
    names = ", ".join(f"'{k}', e.{k}" for k in keys)
    return f"""aggregate({entries},
      named_struct('acc', {start}, 'out', slice(transform({entries}, e -> named_struct({names}, 'state', e.state)), 1, 0)),
      (s, e) -> named_struct('acc', {_compose('s.acc', 'e.state')},
        'out', concat(s.out, array(named_struct({names}, 'state', s.acc)))),
      s -> s.out)"""


def _entering_states(chunks: DataFrame, specs: list[Ewm]) -> DataFrame:
    """For each chunk, the averages at the end of the chunk before it."""
    ordered = "sort_array(collect_list({}))"
    spans = (
        chunks.selectExpr("*", f"_chunk div {CHUNKS_PER_SPAN} AS _span")
        .where("_span IS NOT NULL")
        .groupBy(SYMBOL, "_span")
        .agg(F.expr(ordered.format("struct(_chunk, state)")).alias("chunks"))
    )
    totals = spans.selectExpr(
        SYMBOL,
        "_span",
        f"aggregate(chunks, {_empty(specs)}, (acc, c) -> {_compose('acc', 'c.state')}) AS state",
    )
    series = totals.groupBy(SYMBOL).agg(F.expr(ordered.format("struct(_span, state)")).alias("spans"))
    span_starts = series.selectExpr(
        SYMBOL, f"inline({_prefixes('spans', _empty(specs), ['_span'])})"
    ).withColumnRenamed("state", "start")
    chunk_starts = spans.join(span_starts, [SYMBOL, "_span"]).selectExpr(
        SYMBOL, f"inline({_prefixes('chunks', 'start', ['_chunk'])})"
    )
    # What the rows need of it: the average entering the chunk, rows and values since then.
    return chunk_starts.selectExpr(
        SYMBOL,
        "_chunk",
        "transform(state, r -> r.p * r.x + r.q) AS carry",
        "transform(state, r -> r.trail) AS since",
        "transform(state, r -> r.obs) AS seen",
    )


def _average(x: np.ndarray, alpha: float) -> np.ndarray:
    return pd.Series(x).ewm(alpha=alpha, adjust=False).mean().to_numpy(copy=True)


def _summary(x: np.ndarray, alpha: float) -> dict:
    """The state of one chunk for one average."""
    n, at = len(x), np.flatnonzero(~np.isnan(x))
    if not len(at):
        return {"a": alpha, "n": n, "obs": 0, "lead": 0, "x": None, "p": None, "q": None, "trail": n}
    first, last = int(at[0]), int(at[-1])
    rest = x.copy()
    rest[first] = 0.0
    if len(at) == last - first + 1:
        p = (1.0 - alpha) ** (last - first)
    else:
        unit = np.where(np.isnan(x), np.nan, 0.0)
        unit[first] = 1.0
        p = _average(unit, alpha)[-1]
    return {
        "a": alpha, "n": n, "obs": len(at), "lead": first + 1, "x": x[first], "p": p,
        "q": _average(rest, alpha)[-1], "trail": n - 1 - last,
    }


def _averaged(x: np.ndarray, spec: Ewm, carry: float | None, since: int, seen: int) -> np.ndarray:
    """The averages of one chunk, given the average that enters it."""
    missing = np.isnan(x)
    first = int(np.argmin(missing)) if not missing.all() else len(x)
    if carry is not None and first < len(x):
        old = (1.0 - spec.alpha) ** (since + first + 1)
        x = x.copy()
        x[first] = (old * carry + spec.alpha * x[first]) / (old + spec.alpha)
    y = _average(x, spec.alpha)
    if carry is not None:
        y[:first] = carry
    if spec.min_periods > 1:
        y[seen + np.cumsum(~missing) < spec.min_periods] = np.nan
    return y


def _columns(table: pa.Table, names: list[str]) -> dict[str, np.ndarray]:
    return {n: table.column(n).cast(pa.float64()).to_numpy() for n in names}


def _checked(df: DataFrame, specs: list[Ewm], grain: str) -> tuple[DataFrame, list[str]]:
    """The rows with their chunk, and the columns that are averaged."""
    if any(not 0.0 < s.alpha <= 1.0 for s in specs):
        raise ValueError("alpha must lie in (0, 1]")
    rows = df.withColumn("_chunk", chunk_key(grain)).where("symbol IS NOT NULL AND _chunk IS NOT NULL")
    return rows, sorted({s.source for s in specs})


def ewm_chunks(df: DataFrame, specs: list[Ewm], grain: str) -> DataFrame:
    """symbol, _chunk, state: the summary of each chunk, an entry per spec. Kept from an earlier run, it stands for the chunk's rows."""
    rows, sources = _checked(df, specs, grain)
    state = T.ArrayType(
        T.StructType(
            [
                T.StructField(n, T.DoubleType() if n in "axpq" else T.LongType())
                for n in ("a", "n", "obs", "lead", "x", "p", "q", "trail")
            ]
        )
    )
    chunk_schema = T.StructType(
        [
            T.StructField(SYMBOL, T.StringType()),
            T.StructField("_chunk", T.IntegerType()),
            T.StructField("state", state),
        ]
    )
    chunk_arrow = pa.schema(
        [
            (SYMBOL, pa.string()),
            ("_chunk", pa.int32()),
            (
                "state",
                pa.list_(
                    pa.struct(
                        [
                            (n, pa.float64() if n in "axpq" else pa.int64())
                            for n in ("a", "n", "obs", "lead", "x", "p", "q", "trail")
                        ]
                    )
                ),
            ),
        ]
    )

    def summarize(key, table):
        columns = _columns(table.sort_by(TS), sources)
        states = [_summary(columns[s.source], s.alpha) for s in specs]
        row = {SYMBOL: key[0].as_py(), "_chunk": key[1].as_py(), "state": states}
        return pa.Table.from_pylist([row], schema=chunk_arrow)

    return rows.select(SYMBOL, "_chunk", TS, *sources).groupBy(SYMBOL, "_chunk").applyInArrow(summarize, chunk_schema)


def ewm_scan(df: DataFrame, specs: list[Ewm], grain: str, chunks: DataFrame | None = None) -> DataFrame:
    """Adds one column per spec. The rows are shuffled once, on (symbol, chunk).

    ``chunks`` are the summaries of all chunks of the series, if they are known; then ``df`` need hold only the rows
    of the chunks that are wanted.
    """
    if not specs:
        return df
    rows, sources = _checked(df, specs, grain)

    def finish(key, table, start):
        table = table.sort_by(TS)
        columns = _columns(table, sources)
        enter = start.to_pylist()[0]
        table = table.drop_columns(["_chunk"])
        for i, s in enumerate(specs):
            y = _averaged(columns[s.source], s, enter["carry"][i], enter["since"][i], enter["seen"][i])
            table = table.append_column(s.name, pa.array(y, from_pandas=True))
        return table

    starts = _entering_states(ewm_chunks(df, specs, grain) if chunks is None else chunks, specs)
    if chunks is not None:  # of the chunks whose rows are here
        starts = starts.join(rows.select(SYMBOL, "_chunk").distinct(), [SYMBOL, "_chunk"], "left_semi")
    out_schema = T.StructType(
        df.schema.fields + [T.StructField(s.name, T.DoubleType()) for s in specs]
    )
    return (
        rows.groupBy(SYMBOL, "_chunk")
        .cogroup(starts.groupBy(SYMBOL, "_chunk"))
        .applyInArrow(finish, out_schema)
    )


def _placed(df: DataFrame, grain: str) -> DataFrame:
    """Rows with their chunk and 1-based place in it."""
    in_chunk = Window.partitionBy(SYMBOL, "_chunk").orderBy(TS)
    rows = df.withColumn("_chunk", chunk_key(grain))
    return rows.withColumn("_pos", F.row_number().over(in_chunk).cast("bigint"))


def count_chunks(df: DataFrame, flags: list[str], grain: str) -> DataFrame:
    """symbol, _chunk, _n rows, and for flag i: _s{i} rows with it and _m{i}, the place of the last one."""
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, flag in enumerate(flags):
        aggs += [F.sum(F.col(flag).cast("bigint")).alias(f"_s{i}"), F.max(F.when(F.col(flag), F.col("_pos"))).alias(f"_m{i}")]
    return _placed(df, grain).groupBy(SYMBOL, "_chunk").agg(*aggs)


def running_counts(df: DataFrame, flags: dict[str, tuple[str, str]], grain: str, chunks: DataFrame | None = None) -> DataFrame:
    """For each boolean column: rows with the flag so far, and rows since the last flag.

    ``flags`` maps a flag column to the two output names. Before the first flag the distance
    counts from the start of the series; on a flag row it is 0. ``chunks`` are the counts of all chunks of the
    series, if they are known; then ``df`` need hold only the rows of the chunks that are wanted.
    """
    rows = _placed(df, grain)
    upto = Window.partitionBy(SYMBOL, "_chunk").orderBy(TS).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = {}
    for i, flag in enumerate(flags):
        hit = F.col(flag)
        local[f"_c{i}"] = F.sum(hit.cast("bigint")).over(upto)
        local[f"_l{i}"] = F.max(F.when(hit, F.col("_pos"))).over(upto)
    if chunks is None:
        chunks = count_chunks(df, list(flags), grain)
    # Positions become series-wide once the rows before each chunk are known.
    earlier = (
        Window.partitionBy(SYMBOL).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    )
    chunks = chunks.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    placed = chunks.select(
        SYMBOL, "_chunk", "_before",
        *[F.coalesce(F.sum(f"_s{i}").over(earlier), F.lit(0)).alias(f"_cb{i}") for i in range(len(flags))],
        *[F.max(F.col("_before") + F.col(f"_m{i}")).over(earlier).alias(f"_lb{i}") for i in range(len(flags))],
    )
    rows = rows.withColumns(local).join(placed, [SYMBOL, "_chunk"])
    out = []
    for i, (count_name, since_name) in enumerate(flags.values()):
        place = F.col("_before") + F.col("_pos")
        last = F.coalesce(F.col("_before") + F.col(f"_l{i}"), F.col(f"_lb{i}"), F.lit(1))
        out.append((F.col(f"_cb{i}") + F.col(f"_c{i}")).alias(count_name))
        out.append((place - last).alias(since_name))
    return rows.select(*df.columns, *out)
