"""Row windows over a series without putting the whole series in one task.

A series is cut twice:

* by **chunk**, a calendar piece whose row count has a fixed bound (a minute series has at most
  1,440 rows per day, an hour series 744 per month, a day series 366 per year). Chunk tables are
  small, so running totals over them are cheap even for a symbol that holds most of the rows;
* by **block**, a run of consecutive rows. The last rows of a block are copied to the next one
  (the halo), so a frame that looks back at most ``halo`` rows sees what it would see in a window
  over the whole series.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions import times

SYMBOL = "symbol"
TS = "bar_ts"
BLOCK_ROWS = 8192


def chunk_key(grain: str, ts: str = TS) -> Column:
    """Chunk number for a bar grain: day for minute bars, month for hour bars, year for day bars."""
    col = F.col(ts)
    if grain == "minute":
        return times.epoch_day(col)
    if grain == "hour":
        return F.year(col) * 12 + F.month(col)
    if grain == "day":
        return F.year(col)
    raise ValueError(f"unknown grain {grain!r}")


def with_row_number(df: DataFrame, grain: str) -> DataFrame:
    """Adds ``_chunk`` and ``_rn``, the 0-based position of the row in its series.

    Row numbers are taken per chunk and shifted by the row count of the earlier chunks; the counts
    come from a narrow pass that reads only the key columns and combines map-side.
    """
    rows = df.withColumn("_chunk", chunk_key(grain))
    counts = rows.groupBy(SYMBOL, "_chunk").agg(F.count(F.lit(1)).alias("_n"))
    earlier = (
        Window.partitionBy(SYMBOL).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    )
    before = counts.select(SYMBOL, "_chunk", F.sum("_n").over(earlier).alias("_before"))
    in_chunk = F.row_number().over(Window.partitionBy(SYMBOL, "_chunk").orderBy(TS))
    return (
        rows.withColumn("_pos", in_chunk)
        .join(before, [SYMBOL, "_chunk"])
        .withColumn("_rn", F.coalesce("_before", F.lit(0)) + F.col("_pos") - 1)
        .drop("_before", "_pos")
    )


def with_run_length(df: DataFrame, column: str, grain: str, name: str) -> DataFrame:
    """Adds the number of rows up to this one without a missing ``column`` in between.

    The row of the last missing value comes from the chunk or, through a row per chunk, from an earlier one, so a frame of
    any length is tested by one comparison and needs no rows of its neighbours.
    """
    rows = with_row_number(df, grain)
    missing = F.when(F.col(column).isNull(), F.col("_rn"))
    earlier = Window.partitionBy(SYMBOL).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = rows.groupBy(SYMBOL, "_chunk").agg(F.max(missing).alias("_missing"))
    carried = chunks.select(SYMBOL, "_chunk", F.max("_missing").over(earlier).alias("_carried"))
    inside = F.max(missing).over(Window.partitionBy(SYMBOL, "_chunk").orderBy("_rn"))
    last = F.coalesce(F.greatest("_inside", "_carried"), F.lit(-1))
    return (
        rows.withColumn("_inside", inside)
        .join(carried, [SYMBOL, "_chunk"])
        .withColumn(name, F.col("_rn") - last)
        .drop("_inside", "_carried", "_chunk", "_rn")
    )


def with_first_day(df: DataFrame, grain: str) -> DataFrame:
    """Adds ``_first_day``: the epoch day on which the row's series starts.

    The join is on (symbol, chunk): a symbol with most of the rows stays spread over its chunks.
    """
    rows = df.withColumn("_chunk", chunk_key(grain))
    starts = rows.groupBy(SYMBOL, "_chunk").agg(F.min(times.epoch_day(F.col(TS))).alias("_day"))
    first = F.min("_day").over(Window.partitionBy(SYMBOL))
    starts = starts.select(SYMBOL, "_chunk", first.alias("_first_day"))
    return rows.join(starts, [SYMBOL, "_chunk"]).drop("_chunk")


@dataclass(frozen=True)
class RowFeature:
    """Columns computed from a frame that looks back at most ``halo`` rows."""

    halo: int
    build: Callable[[WindowSpec], dict[str, Column]]


@dataclass(frozen=True)
class Mean:
    """Mean of the latest ``rows`` rows; null below ``min_periods`` values (default: all rows)."""

    source: str
    rows: int
    name: str
    min_periods: int | None = None


def row_features(
    df: DataFrame,
    features: list[RowFeature],
    grain: str,
    means: list[Mean] = (),
    block: int = BLOCK_ROWS,
    ahead: bool = False,
) -> DataFrame:
    """Applies bounded-frame features in order, then rolling means, in one blocked pass.

    A later feature may use the columns of an earlier one, so the halos add up. With ``ahead`` the
    frames look forward: the first rows of a block are copied to the block before it. Added columns
    that start with an underscore are helpers and are dropped at the end.
    """
    halo = sum(f.halo for f in features) + max((m.rows - 1 for m in means), default=0)
    block = max(block, halo)
    place = F.col("_rn") % block
    shared, neighbour = (place < halo, -1) if ahead else (place >= block - halo, 1)
    rows = (
        with_row_number(df, grain)
        .drop("_chunk")
        .withColumn("_own", F.floor(F.col("_rn") / block))
        .withColumn(
            "_blk",
            F.explode(
                F.when(shared, F.array(F.col("_own"), F.col("_own") + neighbour)).otherwise(
                    F.array(F.col("_own"))
                )
            ),
        )
    )
    window = Window.partitionBy(SYMBOL, "_blk").orderBy("_rn")
    for feature in features:
        rows = rows.withColumns(feature.build(window))
    kept = [c for c in rows.columns if c in df.columns or not c.startswith("_")]
    if means:
        return _with_means(rows, list(means), kept)
    return rows.where("_blk = _own").select(*kept)


def _with_means(rows: DataFrame, means: list[Mean], names: list[str]) -> DataFrame:
    """Rolling means of each block, on Arrow columns.

    A frame of n rows costs n additions per row in a window aggregate and one in a rolling mean; a
    sweep has dozens of frames. A block has a fixed number of rows.
    """
    kept = [rows.schema[n] for n in names]

    def roll(table):
        table = table.sort_by("_rn")
        own = pc.equal(table.column("_blk"), table.column("_own"))
        out = table.select(names).filter(own)
        mask = np.asarray(own)
        for source in dict.fromkeys(m.source for m in means):
            values = pd.Series(table.column(source).cast(pa.float64()).to_numpy())
            # Rolling sums keep a trace of values that have left; a frame of zeros has none.
            marks = np.concatenate([[0], np.cumsum(values.fillna(0.0).to_numpy() != 0)])
            for m in means:
                if m.source != source:
                    continue
                least = m.rows if m.min_periods is None else m.min_periods
                mean = values.rolling(m.rows, min_periods=least).mean().to_numpy()
                start = np.maximum(np.arange(len(values)) + 1 - m.rows, 0)
                zeros = (marks[1:] == marks[start]) & ~np.isnan(mean)
                mean = np.where(zeros, 0.0, mean)[mask]
                out = out.append_column(m.name, pa.array(mean, from_pandas=True))
        return out.select(names + [m.name for m in means])

    schema = T.StructType(kept + [T.StructField(m.name, T.DoubleType()) for m in means])
    return rows.groupBy(SYMBOL, "_blk").applyInArrow(roll, schema)
