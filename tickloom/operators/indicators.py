"""Technical indicators: differences, moving averages, RSI, MACD signal lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions import times
from tickloom.functions.names import by_first_number
from tickloom.plans.blocks import Mean, RowFeature, row_features, with_run_length
from tickloom.plans.scan import Ewm, ewm_scan, span_alpha

# Columns that are differenced, and window lists per bar length.
DIFF_FIELDS = ["open", "high", "low", "close", "volume", "vwap", "trade_count"]
AVG_WINDOWS_MINUTES = [2, 3, 5, 8, 12, 10, 20, 26]
AVG_WINDOWS_DAYS_SHORT = [2, 3, 5, 8, 10, 12, 15, 20, 26, 50, 100, 200]
AVG_WINDOWS_DAYS_LONG = [5, 8, 10, 12, 20, 26, 50]
RSI_WINDOWS_MINUTES = [7, 9, 11, 14, 17, 21]
RSI_WINDOWS_DAYS = [5, 7, 9, 11, 14, 17, 21]
MACD_SIGNALS_SHORT = [11, 13, 17, 20, 26]
MACD_SIGNALS_LONG = [11, 13, 17, 20, 26, 30, 50]
RSI_TIMEFRAMES = [1, 2, 3, 5, 10, 30, 60, 120, 1440, 2880, 4320, 7200, 14400, 20160]
RSI_SIMPLE_WINDOWS = [7, 9, 12, 14, 20, 21, 26, 28, 30, 50]


def avg_windows(size: int, unit: str) -> list[int]:
    """Moving-average windows for a bar length; all minute bars share one list."""
    if unit == "min":
        return AVG_WINDOWS_MINUTES
    return AVG_WINDOWS_DAYS_SHORT if size < 100 else AVG_WINDOWS_DAYS_LONG


def _averaged(field: str, windows: list[int]) -> list[str]:
    return [f"{field}_{kind}_{w}m" for w in windows for kind in ("ema", "sma")]


def rsi_plan(size: int, unit: str) -> tuple[list[int], list[str]]:
    """RSI windows and source columns for a bar length."""
    if unit == "min":
        windows = RSI_WINDOWS_MINUTES
        if size <= 10:
            bases = [2]
        elif size <= 30:
            bases = [2, 3, 5]
        elif size < 60:
            bases = [5, 10, 20, 50]
        else:
            bases = [5, 10, 20]
    else:
        windows, bases = RSI_WINDOWS_DAYS, [5, 10, 20, 50]
    return windows, ["close", *_averaged("close", bases)]


def macd_signals(size: int, unit: str) -> list[int]:
    short = size <= 30 if unit == "min" else size < 100
    return MACD_SIGNALS_SHORT if short else MACD_SIGNALS_LONG


# -- bounded frames -------------------------------------------------------------------------


def diff_feature(fields: list[str]) -> RowFeature:
    return RowFeature(
        1, lambda w: {f"{f}_diff": F.col(f) - F.lag(f).over(w) for f in fields}
    )


def gap_feature() -> RowFeature:
    def build(w):
        return {"time_delta": times.seconds_between(F.col("bar_ts"), F.lag("bar_ts").over(w))}

    return RowFeature(1, build)


def _full(field: str, frame, size: int, value: Column) -> Column:
    """The value where the frame holds ``size`` non-null entries, else null."""
    return F.when(F.count(field).over(frame) == size, value)


def sma_means(fields: list[str], windows: list[int]) -> list[Mean]:
    return [Mean(f, n, f"{f}_sma_{n}m") for n in windows for f in fields]


def difference(bars: DataFrame, grain: str, fields: list[str] | None = None) -> DataFrame:
    """Adds ``{field}_diff`` for the listed fields that are present."""
    present = [f for f in (fields or DIFF_FIELDS) if f in bars.columns]
    return row_features(bars, [diff_feature(present)], grain)


def time_gaps(bars: DataFrame, grain: str) -> DataFrame:
    """Adds ``time_delta``: seconds since the previous bar of the series."""
    return row_features(bars, [gap_feature()], grain)


def simple_averages(bars: DataFrame, fields: list[str], windows: list[int], grain: str) -> DataFrame:
    return row_features(bars, [], grain, sma_means(fields, windows))


# -- recurrences ----------------------------------------------------------------------------


def exponential_averages(
    bars: DataFrame, fields: list[str], windows: list[int], grain: str
) -> DataFrame:
    return ewm_scan(bars, ema_specs(fields, windows), grain)


def moving_averages(
    bars: DataFrame,
    fields: list[str],
    windows: list[int],
    grain: str,
    ema: bool = True,
    sma: bool = True,
) -> DataFrame:
    """All simple and exponential averages of all fields over all windows."""
    out = bars
    if sma:
        out = simple_averages(out, fields, windows, grain)
    if ema:
        out = exponential_averages(out, fields, windows, grain)
    return out


def _rsi_value(gain: str, loss: str) -> Column:
    """100 without losses, null without any movement."""
    return F.expr(
        f"if(`{loss}` = 0, if(`{gain}` > 0, 100D, NULL), 100D - 100D / (1D + `{gain}` / `{loss}`))"
    )


def ema_specs(fields: list[str], windows: list[int]) -> list[Ewm]:
    return [Ewm(f, span_alpha(n), f"{f}_ema_{n}m") for n in windows for f in fields]


def rsi_moves(bars: DataFrame, fields: list[str], grain: str) -> DataFrame:
    """Adds ``gain{i}`` and ``loss{i}``, the rise and fall of field i since the row before."""

    def moves(w):
        out = {}
        for i, f in enumerate(fields):
            delta = F.col(f) - F.lag(f).over(w)
            out[f"gain{i}"] = F.coalesce(F.when(delta > 0, delta), F.lit(0.0))
            out[f"loss{i}"] = F.coalesce(F.when(delta < 0, -delta), F.lit(0.0))
        return out

    return row_features(bars, [RowFeature(1, moves)], grain)


def rsi_specs(fields: list[str], windows: list[int]) -> list[Ewm]:
    return [
        Ewm(f"{side}{i}", 1.0 / n, f"{side}{i}_{n}", min_periods=n)
        for i in range(len(fields))
        for n in windows
        for side in ("gain", "loss")
    ]


def rsi_values(fields: list[str], windows: list[int]) -> list[Column]:
    return [
        _rsi_value(f"gain{i}_{n}", f"loss{i}_{n}").alias(f"{f}_{n}window_rsi")
        for i, f in enumerate(fields)
        for n in windows
    ]


def rsi(bars: DataFrame, fields: list[str], windows: list[int], grain: str) -> DataFrame:
    """Adds ``{field}_{n}window_rsi`` (smoothed with alpha = 1/n) for all fields and windows."""
    smoothed = ewm_scan(rsi_moves(bars, fields, grain), rsi_specs(fields, windows), grain)
    return smoothed.select(*bars.columns, *rsi_values(fields, windows))


def macd_pairs(ema_columns: list[str]) -> list[tuple[str, str]]:
    """(fast, slow) pairs, ordered by the window number in the name."""
    cols = by_first_number(ema_columns)
    return [(a, b) for i, a in enumerate(cols) for b in cols[i + 1 :]]


def macd_lines(bars: DataFrame, ema_columns: list[str]) -> DataFrame:
    return bars.withColumns({f"MACD_{a}_{b}": F.col(a) - F.col(b) for a, b in macd_pairs(ema_columns)})


def macd_specs(ema_columns: list[str], signals: list[int]) -> list[Ewm]:
    pairs = macd_pairs(ema_columns)
    return [Ewm(f"MACD_{a}_{b}", span_alpha(n), f"Signal_{a}_{b}_signal{n}") for n in signals for a, b in pairs]


def macd(
    bars: DataFrame,
    ema_columns: list[str],
    signals: list[int],
    grain: str,
    lines: bool = False,
    histograms: bool = False,
) -> DataFrame:
    """Signal lines of every EMA pair; optionally the MACD lines and histograms as well."""
    pairs = macd_pairs(ema_columns)
    out = ewm_scan(macd_lines(bars, ema_columns), macd_specs(ema_columns, signals), grain)
    if histograms:
        out = out.withColumns(
            {
                f"Histogram_{a}_{b}_signal{n}": F.col(f"MACD_{a}_{b}")
                - F.col(f"Signal_{a}_{b}_signal{n}")
                for n in signals
                for a, b in pairs
            }
        )
    return out if lines else out.drop(*[f"MACD_{a}_{b}" for a, b in pairs])


# -- simple-average RSI ---------------------------------------------------------------------


def simple_rsi(
    bars: DataFrame,
    windows: list[int],
    grain: str,
    timeframes: list[int] = (1,),
    kinds: list[str] = ("close_prev", "close_open"),
) -> DataFrame:
    """RSI from plain rolling means of gains and losses (partial frames allowed).

    ``close_prev`` uses the change from the previous bar, ``close_open`` the bar's own body. For a
    timeframe n the close is taken only once n non-null rows are in its frame. Adds
    ``{kind}_rsi_{window}_{n}T``.
    """

    def closes(w):
        return {f"close_last_{n}T": F.when(F.col("run") >= n, F.col("close")) for n in timeframes}

    def moves(w):
        out = {}
        for n in timeframes:
            last = F.col(f"close_last_{n}T")
            delta = {"close_prev": last - F.lag(last).over(w), "close_open": last - F.col("open")}
            for kind in kinds:
                d = delta[kind]
                out[f"_gain_{kind}_{n}"] = F.coalesce(F.when(d > 0, d), F.lit(0.0))
                out[f"_loss_{kind}_{n}"] = F.coalesce(F.when(d < 0, -d), F.lit(0.0))
        return out

    sides = [(kind, n) for n in timeframes for kind in kinds]
    means = [
        Mean(f"_{side}_{kind}_{n}", size, f"{side}_{kind}_{n}_{size}", min_periods=1)
        for kind, n in sides
        for side in ("gain", "loss")
        for size in windows
    ]
    rows = row_features(with_run_length(bars, "close", grain, "run"), [RowFeature(0, closes), RowFeature(1, moves)], grain, means)
    values = [
        _rsi_value(f"gain_{kind}_{n}_{size}", f"loss_{kind}_{n}_{size}").alias(
            f"{kind}_rsi_{size}_{n}T"
        )
        for kind, n in sides
        for size in windows
    ]
    return rows.select(*bars.columns, *[f"close_last_{n}T" for n in timeframes], *values)


def overlapping_years(bars: DataFrame, warmup_days: int = 3) -> DataFrame:
    """Rows keyed by calendar year, each year preceded by a few days of the year before.

    The last days of December are also sent to the next year with ``warmup`` set, so yearly jobs
    can run apart and drop their warm-up rows at the end.
    """
    day = F.to_date("bar_ts")
    year = F.year("bar_ts")
    late = F.date_add(day, warmup_days) >= F.make_date(year + 1, F.lit(1), F.lit(1))
    slots = F.when(late, F.array(year, year + 1)).otherwise(F.array(year))
    return bars.withColumn("year", F.explode(slots)).withColumn(
        "warmup", F.col("year") > F.year("bar_ts")
    )


def yearly_averages(
    bars: DataFrame, fields: list[str], windows: list[int], warmup_days: int = 3
) -> DataFrame:
    """Simple averages per (symbol, calendar year) with a few days of warm-up rows.

    A year restarts the frame, so this is the chunked approximation; the blocked plan is exact.
    """
    w = Window.partitionBy("symbol", "year").orderBy("bar_ts")
    averages = {
        f"{f}_sma_{n}m": _full(f, w.rowsBetween(-(n - 1), 0), n, F.avg(f).over(w.rowsBetween(-(n - 1), 0)))
        for n in windows
        for f in fields
    }
    return overlapping_years(bars, warmup_days).withColumns(averages).where("not warmup").drop("warmup")
