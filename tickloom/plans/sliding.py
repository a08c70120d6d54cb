"""Extremes and slopes of wide frames in a time that doesn't depend on their width.

A window aggregate looks at every row of a frame, so a frame of a week costs a hundred times one of half an hour. Here a
frame of n rows is two look-ups a row. Extremes: the rows are cut every n rows, running extremes go
from each cut forward and back, and a frame is the end of one run and the start of the next. Slopes: differences of
running sums of x, x*x, y and x*y. Spark deals the rows in blocks with the neighbours' rows that their frames need (blocks.py),
or in runs of whole days, and a task holds one of those at a time.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions import times
from tickloom.plans.blocks import BLOCK_ROWS, SYMBOL, TS, with_row_number

#: Whole days that one task takes together, at most 1,440 minute bars each.
DAYS_TOGETHER = 8


@dataclass(frozen=True)
class Extreme:
    """Largest or smallest ``source`` of the rows from offset ``first`` to ``last``; null below ``least`` values."""

    source: str
    name: str
    first: int
    last: int
    largest: bool = True
    least: int = 1


@dataclass(frozen=True)
class Slope:
    """Least-squares slope of ``source``, per row, over the rows from offset ``first`` to ``last``.

    Missing values are left out; null below ``least`` values (two at least), and where the frame isn't whole if ``whole``.
    """

    source: str
    name: str
    first: int
    last: int
    least: int = 2
    whole: bool = True


def _bounds(n: int, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each row's frame, its first row and the one behind its last, inside the n rows."""
    rows = np.arange(n)
    start = np.clip(rows + first, 0, n)
    return start, np.maximum(np.clip(rows + last + 1, 0, n), start)


def extremes(values: np.ndarray, frame: Extreme) -> np.ndarray:
    """One value a row, NaN for none. NaN in ``values`` is a missing value."""
    n, width = len(values), frame.last - frame.first + 1
    seen = np.concatenate([[0], np.cumsum(~np.isnan(values))])
    start, stop = _bounds(n, frame.first, frame.last)
    enough = seen[stop] - seen[start] >= max(1, frame.least)
    if not enough.any():
        return np.full(n, np.nan)
    best = np.maximum if frame.largest else np.minimum
    none = -np.inf if frame.largest else np.inf
    # Rows before and behind count as missing; then all frames are whole. A width beyond the rows is no more than all of them.
    before, behind = min(max(0, -frame.first), n), min(max(0, frame.last), n)
    low, high = max(frame.first, -n), min(frame.last, n)
    width = high - low + 1
    total = -(-(before + n + behind + width) // width) * width
    padded = np.full(total, none)
    padded[before : before + n] = np.where(np.isnan(values), none, values)
    runs = padded.reshape(-1, width)
    forward = best.accumulate(runs, axis=1).ravel()
    back = best.accumulate(runs[:, ::-1], axis=1)[:, ::-1].ravel()
    at = np.arange(n) + low + before
    return np.where(enough, best(back[at], forward[at + width - 1]), np.nan)


def slopes(values: np.ndarray, frame: Slope) -> np.ndarray:
    """One slope a row, NaN for none. Values are centred first, and the sums kept in long doubles."""
    n = len(values)
    there = ~np.isnan(values)
    if not there.any():
        return np.full(n, np.nan)
    x = np.arange(n, dtype=np.int64)
    y = np.where(there, values - values[there].mean(), 0.0)
    start, stop = _bounds(n, frame.first, frame.last)

    def over(terms, kind):
        sums = np.concatenate([np.zeros(1, kind), np.cumsum(terms.astype(kind))])
        return sums[stop] - sums[start]

    count, sum_x, sum_xx = (over(np.where(there, t, 0), np.int64) for t in (np.ones(n, np.int64), x, x * x))
    sum_y, sum_xy = (over(t, np.longdouble) for t in (y, x * y))
    # Measured from the frame's first row, so that products stay small.
    sum_xx = sum_xx - 2 * start * sum_x + start * start * count
    sum_x, sum_xy = sum_x - start * count, sum_xy - start * sum_y
    spread = count * sum_xx - sum_x * sum_x
    enough = (count >= max(2, frame.least)) & (spread > 0)
    if frame.whole:
        enough &= stop - start == frame.last - frame.first + 1
    found = (count * sum_xy - sum_x * sum_y) / np.where(enough, spread, 1)
    return np.where(enough, found, np.nan).astype(np.float64)


def sliding(df: DataFrame, frames: list[Extreme | Slope], grain: str, by_day: bool = False, block: int = BLOCK_ROWS) -> DataFrame:
    """Adds a double column for each frame, over the series or, with ``by_day``, inside (symbol, day).

    ``(symbol, bar_ts)`` is unique and neither is null. A frame wider than a block makes the blocks as wide. Null and NaN are missing
    values. Columns with a leading underscore are reserved; an empty table gives an empty result.
    """
    names = df.columns
    clash = [f.name for f in frames if f.name in names] or [f.name for f in frames if f.last < f.first]
    if clash:
        raise ValueError(f"columns that exist already, or empty frames: {clash}")
    if by_day:
        day = times.epoch_day(F.col(TS))
        rows = df.withColumns({"_day": day, "_blk": F.floor(day / DAYS_TOGETHER), "_rn": times.epoch_minute(F.col(TS))}).withColumn("_own", F.col("_blk"))
    else:
        back, ahead = max(0, *(-f.first for f in frames)), max(0, *(f.last for f in frames))
        size = max(block, back, ahead)
        place, own = F.col("_rn") % size, F.floor(F.col("_rn") / size)
        wanted = F.array(own, F.when(place >= size - back, own + 1), F.when(place < ahead, own - 1))
        rows = with_row_number(df, grain).drop("_chunk").withColumn("_own", own).withColumn("_blk", F.explode(F.array_compact(wanted))).withColumn("_day", F.lit(0))
    order = [("_rn", "ascending"), (TS, "ascending")]

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by(order).combine_chunks()
        kept = pc.equal(table.column("_blk"), table.column("_own"))
        days = table.column("_day").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(days)) + 1).tolist(), len(days)]
        out = table.select(names).filter(kept)
        mask = kept.to_numpy()
        for f in frames:
            values = np.array(table.column(f.source).cast(pa.float64()).to_numpy(zero_copy_only=False), dtype=np.float64)
            kernel = extremes if isinstance(f, Extreme) else slopes
            found = np.concatenate([kernel(values[a:b], f) for a, b in zip(cuts, cuts[1:])])[mask]
            out = out.append_column(f.name, pa.array(found, from_pandas=True))
        return out

    schema = T.StructType([df.schema[n] for n in names] + [T.StructField(f.name, T.DoubleType()) for f in frames])
    return rows.groupBy(SYMBOL, "_blk").applyInArrow(run, schema)
