"""Per-row custom features: lags, direction streaks, local extrema, running day extremes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.plans.blocks import RowFeature, row_features
from tickloom.plans.scan import running_counts
from tickloom.sources.storage import stage

# Number of lags and sizes of the extrema windows.
LAGS = list(range(1, 16))
EXTREMA_WINDOWS = [5, 10, 15, 30]


def _day(*extra: str):
    w = Window.partitionBy("symbol", F.to_date("bar_ts"), *extra).orderBy("bar_ts")
    return w.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def lag_feature(fields: list[str], lags: list[int] = LAGS) -> RowFeature:
    return RowFeature(
        max(lags), lambda w: {f"{f}_lag_{n}": F.lag(f, n).over(w) for n in lags for f in fields}
    )


def direction_of(change: Column) -> Column:
    """'up', 'down' or 'no change'; a missing change counts as 'no change'."""
    return F.when(change > 0, "up").when(change < 0, "down").otherwise("no change")


def direction_features(price: str = "close") -> list[RowFeature]:
    """``price_change, direction`` and the two reversal flags."""

    def change(w):
        return {"price_change": F.col(price) - F.lag(price).over(w)}

    def direction(w):
        return {"direction": direction_of(F.col("price_change"))}

    def reversals(w):
        now, prev = F.col("direction"), F.lag("direction").over(w)
        return {
            "direction_change_up_to_down": F.coalesce((now == "down") & (prev == "up"), F.lit(False)),
            "direction_change_down_to_up": F.coalesce((now == "up") & (prev == "down"), F.lit(False)),
        }

    return [RowFeature(1, change), RowFeature(0, direction), RowFeature(1, reversals)]


def lags(bars: DataFrame, fields: list[str], grain: str, steps: list[int] = LAGS) -> DataFrame:
    return row_features(bars, [lag_feature(fields, steps)], grain)


def directions(bars: DataFrame, grain: str, price: str = "close") -> DataFrame:
    return row_features(bars, direction_features(price), grain)


def day_finals(rows: DataFrame) -> DataFrame:
    """symbol, _date, _ups, _downs: each day's final numbers."""
    up, down = F.col("direction") == "up", F.col("direction") == "down"
    return rows.groupBy("symbol", F.to_date("bar_ts").alias("_date")).agg(F.count_if(up).alias("_ups"), F.count_if(down).alias("_downs"))


def with_day_counts(rows: DataFrame, finals: DataFrame | None = None) -> DataFrame:
    """Ups and downs so far today, and yesterday's final numbers on every row of the day.

    Yesterday's numbers come from a one-row-per-day table, not from a window over the series; ``finals`` is that table, if
    the rows are not all of the series.
    """
    up, down = F.col("direction") == "up", F.col("direction") == "down"
    if finals is None:
        finals = day_finals(rows)
    rows = rows.withColumn("_date", F.to_date("bar_ts"))
    days = Window.partitionBy("symbol").orderBy("_date")
    previous = finals.select(
        "symbol",
        "_date",
        F.lag("_ups").over(days).alias("prev_cumulative_ups"),
        F.lag("_downs").over(days).alias("prev_cumulative_downs"),
    )
    today = (
        Window.partitionBy("symbol", "_date")
        .orderBy("bar_ts")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        rows.withColumns(
            {
                "cumulative_ups": F.count_if(up).over(today),
                "cumulative_downs": F.count_if(down).over(today),
            }
        )
        .join(previous, ["symbol", "_date"])
        .drop("_date")
    )


def extrema_feature(windows: list[int] = EXTREMA_WINDOWS) -> RowFeature:
    """``local_max_n`` / ``local_min_n``: close at or beyond the extreme of the n rows before it."""

    def build(w):
        out = {}
        close = F.col("close")
        for n in windows:
            prior = w.rowsBetween(-n, -1)
            full = F.count("close").over(prior) == n
            out[f"local_max_{n}"] = F.coalesce(full & (close >= F.max("close").over(prior)), F.lit(False))
            out[f"local_min_{n}"] = F.coalesce(full & (close <= F.min("close").over(prior)), F.lit(False))
        return out

    return RowFeature(max(windows), build)


def local_extrema(bars: DataFrame, grain: str, windows: list[int] = EXTREMA_WINDOWS) -> DataFrame:
    return row_features(bars, [extrema_feature(windows)], grain)


def extrema_names(windows: list[int] = EXTREMA_WINDOWS) -> dict[str, tuple[str, str]]:
    """Flag columns and the names of their counts and distances."""
    return {
        f"local_{side}_{n}": (f"cumulative_local_{side}_{n}", f"time_since_prev_{side}_{n}")
        for n in windows
        for side in ("max", "min")
    }


def with_extrema_counts(
    rows: DataFrame, grain: str, windows: list[int] = EXTREMA_WINDOWS, chunks: DataFrame | None = None
) -> DataFrame:
    """Extrema seen so far in the series, and rows since the latest one; ``chunks`` as in ``running_counts``."""
    return running_counts(rows, extrema_names(windows), grain, chunks)


def date_extremes(rows: DataFrame) -> DataFrame:
    """symbol, _date, market_open, _high, _low: extremes of each date and session."""
    keys = ["symbol", F.to_date("bar_ts").alias("_date"), "market_open"]
    return rows.groupBy(*keys).agg(F.max("high").alias("_high"), F.min("low").alias("_low"))


def with_day_extremes(rows: DataFrame, by: str = "day_of_year", earlier: DataFrame | None = None) -> DataFrame:
    """Running high and low of the day, and of the day's open or closed session.

    The default groups by day of the year only, so the same day of several years is one group;
    ``by='date'`` separates the years. Null highs and lows stay null. ``earlier`` has the ``date_extremes`` of the dates
    before the rows, if the rows are not all of the series.
    """
    key = F.dayofyear("bar_ts") if by == "day_of_year" else F.to_date("bar_ts")
    names = {"_eh": F.lit(None), "_el": F.lit(None), "_eh_session": F.lit(None), "_el_session": F.lit(None)}
    if earlier is not None and by == "day_of_year":
        keyed = earlier.groupBy("symbol", F.dayofyear("_date").alias("_doy"), F.col("market_open").alias("_open"))
        parts = keyed.agg(F.max("_high").alias("_eh_session"), F.min("_low").alias("_el_session"))
        whole = parts.groupBy("symbol", "_doy").agg(F.max("_eh_session").alias("_eh"), F.min("_el_session").alias("_el"))
        columns = rows.columns
        rows = rows.withColumns({"_doy": key, "_open": F.col("market_open")}).join(whole, ["symbol", "_doy"], "left")
        rows = rows.join(parts, ["symbol", "_doy", "_open"], "left").select(*columns, *names)
        names = {n: F.col(n) for n in names}

    def running(*extra):
        w = Window.partitionBy("symbol", key, *extra).orderBy("bar_ts")
        return w.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def high(frame, before):
        return F.when(F.col("high").isNotNull(), F.greatest(F.max("high").over(frame), before.cast("double")))

    def low(frame, before):
        return F.when(F.col("low").isNotNull(), F.least(F.min("low").over(frame), before.cast("double")))

    day, session = running(), running("market_open")
    return rows.withColumns(
        {
            "max_today": high(day, names["_eh"]),
            "min_today": low(day, names["_el"]),
            "max_today_session": high(session, names["_eh_session"]),
            "min_today_session": low(session, names["_el_session"]),
        }
    ).drop(*names)


def with_calendar_parts(rows: DataFrame) -> DataFrame:
    return rows.withColumns(
        {
            "hour": F.hour("bar_ts"),
            "minute": F.minute("bar_ts"),
            "day_of_year": F.dayofyear("bar_ts"),
        }
    )


def one_hot_direction(rows: DataFrame) -> DataFrame:
    """``direction`` -> boolean columns for every level but the first ('down')."""
    return rows.withColumns(
        {level: F.col("direction") == level for level in ("no change", "up")}
    ).drop("direction")


def daily_direction_changes(bars: DataFrame, grain: str, price: str = "close") -> DataFrame:
    """Rows per symbol and day whose direction differs from the row before and is not flat."""

    def prev(w):
        return {"previous": F.lag("direction").over(w)}

    rows = row_features(bars, [*direction_features(price)[:2], RowFeature(1, prev)], grain)
    changed = ~F.col("direction").eqNullSafe(F.col("previous")) & (F.col("direction") != "no change")
    return rows.groupBy("symbol", F.to_date("bar_ts").alias("date")).agg(
        F.count_if(changed).alias("daily_direction_changes")
    )


def frame_features(lag_fields: list[str]) -> list[RowFeature]:
    """The features of this module that look back a bounded number of rows."""
    return [lag_feature(lag_fields), *direction_features(), extrema_feature()]


def custom_features(bars: DataFrame, lag_fields: list[str], grain: str = "minute") -> DataFrame:
    """Every feature of this module on one table, encoded for training.

    The blocked pass is staged, because the counts that follow read it more than once.
    """
    rows = stage(row_features(bars, frame_features(lag_fields), grain))
    rows = with_extrema_counts(rows, grain)
    rows = with_day_counts(rows)
    rows = with_day_extremes(with_calendar_parts(rows))
    return one_hot_direction(rows)
