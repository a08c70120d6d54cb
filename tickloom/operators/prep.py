"""Bar preparation: checks, time zones, minute filling, resampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions import times
from tickloom.functions.names import split_duration
from tickloom.plans.blocks import with_first_day

PRICES = ["open", "high", "low", "close"]

# Bar lengths produced from minute, hour and day bars.
MINUTE_DURATIONS = ["2min", "3min", "5min", "10min", "15min", "20min", "25min", "30min"]
HOUR_DURATIONS = ["120min", "180min", "240min"]
DAY_DURATIONS = ["2D", "3D", "5D", "10D", "15D", "20D", "30D", "50D", "100D", "150D", "200D"]


# -- checks ---------------------------------------------------------------------------------


def null_price_counts(bars: DataFrame) -> DataFrame:
    """One row: rows, and missing values of each price column."""
    return bars.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"{c}_missing") for c in PRICES],
    )


def require_prices(bars: DataFrame) -> DataFrame:
    """Raises when any price is missing; returns the bars otherwise."""
    report = null_price_counts(bars).first().asDict()
    bad = [c for c in PRICES if report[f"{c}_missing"]]
    if bad:
        raise ValueError(f"missing values in {', '.join(bad)}")
    return bars


def quarantine(bars: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Splits into (complete rows, rows with a missing price) instead of raising."""
    missing = F.lit(False)
    for c in PRICES:
        missing = missing | F.col(c).isNull()
    return bars.where(~missing), bars.where(missing)


def keyed(bars: DataFrame) -> DataFrame:
    """Rows with a symbol and a time. All other operators expect these; ``unkeyed`` has the rest."""
    return bars.where(F.col("symbol").isNotNull() & F.col("bar_ts").isNotNull())


def unkeyed(bars: DataFrame) -> DataFrame:
    """Rows without a symbol or a time, with the names of what is ``missing``; to be set aside, not lost."""
    missing = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in ("symbol", "bar_ts")]))
    return bars.withColumn("missing", F.array_join(missing, ",")).where("missing <> ''")


def duplicate_bars(bars: DataFrame) -> DataFrame:
    """Keys that occur more than once; an empty result means every series is strictly ordered."""
    return (
        bars.groupBy("symbol", "bar_ts").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")
    )


def disordered(stored: DataFrame, series: str = "symbol", ts: str = "bar_ts", run: int = 65_536) -> DataFrame:
    """Series that are not in time order as stored: ``file``, the series, ``rows``, ``out_of_order`` and the first such row.

    ``stored`` is a scan of Parquet files. A row is out of order if an earlier row of its file and series has a later time;
    ``first_row`` is its position in the file, ``first_ts`` its time and ``after_ts`` the latest time before it. Rows without a time are
    counted, but are never out of order; rows without a series are a series. Files are cut in runs of ``run`` rows, and the latest time
    of the earlier runs comes from a row per run, so a long file is no single task's.
    """
    place = F.col("_metadata.row_index")
    rows = stored.select(F.col("_metadata.file_path").alias("file"), place.alias("_row"), F.col(series).alias("_series"), F.col(ts).alias("_ts"))
    rows = rows.withColumn("_run", F.floor(F.col("_row") / run))
    inside = Window.partitionBy("file", "_series", "_run").orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("file", "_series").orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    runs = rows.groupBy("file", "_series", "_run").agg(F.max("_ts").alias("_latest"))
    runs = runs.select(*[F.col(c).alias(f"{c}_of") for c in ("file", "_series", "_run")], F.max("_latest").over(earlier).alias("_carried"))
    same = (F.col("file") == F.col("file_of")) & F.col("_series").eqNullSafe(F.col("_series_of")) & (F.col("_run") == F.col("_run_of"))
    joined = rows.withColumn("_inside", F.max("_ts").over(inside)).join(runs, same).withColumn("_before", F.greatest("_inside", "_carried"))
    bad = F.col("_ts") < F.col("_before")
    found = joined.groupBy("file", "_series").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(bad).alias("out_of_order"), F.min(F.when(bad, F.struct("_row", "_ts", "_before"))).alias("_first")
    )
    first = [F.col(f"_first.{c}").alias(name) for c, name in (("_row", "first_row"), ("_ts", "first_ts"), ("_before", "after_ts"))]
    return found.where("out_of_order > 0").select("file", F.col("_series").alias(series), "rows", "out_of_order", *first)


def require_order(stored: DataFrame, series: str = "symbol", ts: str = "bar_ts") -> DataFrame:
    """Raises when a series is not in time order as stored, naming the first; returns the rows otherwise."""
    bad = disordered(stored, series, ts).orderBy("file", series).first()
    if bad:
        raise ValueError(f"{bad[series]} is out of order at row {bad['first_row']} of {bad['file']}: {bad['first_ts']} after {bad['after_ts']}")
    return stored


# -- time -----------------------------------------------------------------------------------


def localize(bars: DataFrame, ts: str = "timestamp") -> DataFrame:
    """UTC instants in ``ts`` -> naive US/Eastern ``bar_ts``; ``ts`` is dropped."""
    if dict(bars.dtypes)[ts] == "timestamp":
        local = times.instant_to_eastern(F.col(ts))
    else:
        local = times.to_eastern(F.col(ts))
    return bars.withColumn("bar_ts", local).drop(ts)


def with_market_open(bars: DataFrame) -> DataFrame:
    return bars.withColumn("market_open", times.market_open(F.col("bar_ts")))


# -- filling --------------------------------------------------------------------------------


def fill_minutes(bars: DataFrame, zero_volume: bool = False) -> DataFrame:
    """One row per minute between the first and last bar of each (symbol, day).

    A missing minute repeats the latest earlier bar, volume and trade count included; with
    ``zero_volume`` those two are 0 in filled minutes. Every bar is expanded up to the next one, so
    no time grid is built and joined; a day holds at most 1,440 minutes.
    """
    day = Window.partitionBy("symbol", "_day").orderBy("_minute")
    own = F.col("_minute")
    rows = (
        bars.withColumn("_minute", times.epoch_minute(F.col("bar_ts")))
        .withColumn("_day", times.epoch_day(F.col("bar_ts")))
        .withColumn("_last", F.coalesce(F.lead("_minute").over(day) - 1, own))
        .withColumn("_slot", F.explode(F.sequence(own, F.greatest(own, F.col("_last")))))
    )
    filled = {}
    for c in ("open", "high", "low", "vwap"):
        if c in bars.columns:
            filled[c] = F.coalesce(c, "close")
    for c in ("volume", "trade_count"):
        if c in bars.columns:
            value = F.coalesce(c, F.lit(0.0))
            filled[c] = F.when(F.col("_slot") == own, value).otherwise(0.0) if zero_volume else value
    filled["bar_ts"] = times.from_epoch_minute(F.col("_slot"))
    return rows.withColumns(filled).select(*bars.columns)


# -- resampling -----------------------------------------------------------------------------


def _first(c: str) -> Column:
    """Value of the earliest ``bar_ts`` that has one; of equal times the smallest value."""
    return F.min(F.when(F.col(c).isNotNull(), F.struct("bar_ts", c)))[c].alias(c)


def _last(c: str) -> Column:
    """Value of the latest ``bar_ts`` that has one; of equal times the largest value."""
    return F.max(F.when(F.col(c).isNotNull(), F.struct("bar_ts", c)))[c].alias(c)


def _bar_aggregates(columns: list[str]) -> list[Column]:
    aggs = [_first("open"), F.max("high").alias("high"), F.min("low").alias("low"), _last("close")]
    for c in ("volume", "trade_count"):
        if c in columns:
            aggs.append(F.coalesce(F.sum(c), F.lit(0.0)).alias(c))
    if "market_open" in columns:
        aggs.append(F.bool_or("market_open").alias("market_open"))
    return aggs


def _with_origin(bars: DataFrame, widths: list[int], grain: str, first_days: DataFrame | None = None) -> tuple[DataFrame, Column]:
    """Adds ``_minute``; returns the rows and the minute from which bins are counted.

    Bins start at midnight of the series' first day. When all widths divide a day, every midnight
    gives the same bins and no look-up is needed; 25 minutes or several days need the first day. ``first_days``
    (symbol, _first_day) has it, a row per series, if the rows are not all of the series.
    """
    rows = bars.withColumn("_minute", times.epoch_minute(F.col("bar_ts")))
    if all(times.MINUTES_PER_DAY % w == 0 for w in widths):
        return rows, F.lit(0)
    rows = with_first_day(rows, grain) if first_days is None else rows.join(first_days, "symbol")
    return rows, F.col("_first_day") * times.MINUTES_PER_DAY


def _with_bin(bars: DataFrame, width: int, grain: str, first_days: DataFrame | None = None) -> DataFrame:
    """``_bin``: start (epoch minute) of the row's bin."""
    rows, origin = _with_origin(bars, [width], grain, first_days)
    return rows.withColumn("_bin", times.bin_start_minute(F.col("_minute"), width, origin))


def resample(bars: DataFrame, width: int, keep_unaligned: bool = False) -> DataFrame:
    """Bars of ``width`` minutes from minute or hour bars.

    A bin is kept only when a source bar sits on its left edge, which is the same as the earliest
    minute of the bin being its start; ``keep_unaligned`` keeps the others too.
    """
    binned = _with_bin(bars, width, "hour")
    out = binned.groupBy("symbol", "_bin").agg(
        *_bar_aggregates(bars.columns), F.min("_minute").alias("_edge")
    )
    if not keep_unaligned:
        out = out.where("_edge = _bin")
    return out.withColumn("bar_ts", times.from_epoch_minute(F.col("_bin"))).select(
        "symbol", "bar_ts", *[c for c in bars.columns if c in out.columns and c not in ("symbol", "bar_ts")]
    )


def resample_days(bars: DataFrame, days: int, first_days: DataFrame | None = None) -> DataFrame:
    """Bars of several days from daily bars; empty bins stay, with null prices and volume 0."""
    width = days * times.MINUTES_PER_DAY
    keep = [c for c in bars.columns if c in ("symbol", "bar_ts", "open", "high", "low", "close", "volume")]
    out = _with_bin(bars.select(*keep), width, "day", first_days).groupBy("symbol", "_bin").agg(*_bar_aggregates(keep))
    # One row per bin and symbol: bounded by the calendar.
    nxt = F.lead("_bin").over(Window.partitionBy("symbol").orderBy("_bin"))
    slots = out.withColumn("_next", nxt).withColumn(
        "_slot",
        F.explode(
            F.sequence(
                F.col("_bin"), F.coalesce(F.col("_next") - width, F.col("_bin")), F.lit(width)
            )
        ),
    )
    filled = F.col("_slot") == F.col("_bin")
    values = {c: F.when(filled, F.col(c)) for c in PRICES}
    if "volume" in keep:
        values["volume"] = F.when(filled, F.col("volume")).otherwise(0.0)
    values["bar_ts"] = times.from_epoch_minute(F.col("_slot"))
    return slots.withColumns(values).select(*keep)


def resample_many(
    bars: DataFrame, durations: list[int], keep_unaligned: bool = False, first_days: DataFrame | None = None
) -> DataFrame:
    """All minute-family bar lengths from one pass over the bars, as one table keyed by ``duration``.

    Each bar is sent to one bin per length and combined map-side, so the bars are read and filled
    once instead of once per length.
    """
    rows, origin = _with_origin(bars, durations, "hour", first_days)
    bins = F.array(
        *[
            F.struct(
                F.lit(f"{d}min").alias("duration"),
                times.bin_start_minute(F.col("_minute"), d, origin).alias("bin"),
            )
            for d in durations
        ]
    )
    out = (
        rows.withColumn("_b", F.explode(bins))
        .groupBy("symbol", F.col("_b.duration").alias("duration"), F.col("_b.bin").alias("_bin"))
        .agg(*_bar_aggregates(bars.columns), F.min("_minute").alias("_edge"))
    )
    if not keep_unaligned:
        out = out.where("_edge = _bin")
    return out.withColumn("bar_ts", times.from_epoch_minute(F.col("_bin"))).drop("_bin", "_edge")


def daily_from_minutes(bars: DataFrame) -> DataFrame:
    """Open, close, high, low per symbol and calendar day."""
    rows = bars.withColumn("_minute", times.epoch_minute(F.col("bar_ts")))
    return rows.groupBy("symbol", F.to_date("bar_ts").alias("date")).agg(
        _first("open"), _last("close"), F.max("high").alias("high"), F.min("low").alias("low")
    )
