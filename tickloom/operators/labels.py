"""Reversal labels: 'A' (turn up), 'B' (turn down), 'C' (undecided).

All frames stay inside one (symbol, day), which holds at most 1,440 minute bars.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.plans.blocks import RowFeature, row_features

# Class codes of the labels.
CATEGORY_CODES = {"A": 0, "B": 1, "C": 2}
# Slopes are rounded half up to this many digits, the last bits of the regression being noise, and
# then compared plainly; one that equals its threshold is not beyond it.
SLOPE_DIGITS = 9


@dataclass(frozen=True)
class ReversalRule:
    """Thresholds of the production label. The defaults are fixed values."""

    prev_points: int = 11
    positive_slope: float = 0.013
    negative_slope: float = -0.026
    rise: float = 0.0007
    drop: float = 0.0012
    high_window: int = 30
    low_window: int = 30


def _day_window():
    return Window.partitionBy("symbol", "_day").orderBy("bar_ts")


def _with_day_position(bars: DataFrame) -> DataFrame:
    """``_i``: 0-based row number in the day; ``_n``: rows in the day."""
    whole = Window.partitionBy("symbol", "_day")
    return bars.withColumn("_day", F.to_date("bar_ts")).withColumns(
        {
            "_i": F.row_number().over(_day_window()) - 1,
            "_n": F.count(F.lit(1)).over(whole),
        }
    )


def trailing_slope(field: str, size: int) -> Column:
    """Least-squares slope of the ``size`` rows before the current one, in units per row."""
    slope = F.regr_slope(F.col(field), F.col("_i")).over(_day_window().rowsBetween(-size, -1))
    return F.floor(slope * F.lit(10.0**SLOPE_DIGITS) + 0.5) / F.lit(10.0**SLOPE_DIGITS)


def future_max(field: str, size: int) -> Column:
    return F.max(field).over(_day_window().rowsBetween(1, size))


def future_min(field: str, size: int) -> Column:
    return F.min(field).over(_day_window().rowsBetween(1, size))


def trailing_slopes(bars: DataFrame, field: str, size: int) -> DataFrame:
    rows = _with_day_position(bars).withColumn(
        "slope", F.when(F.col("_i") >= size, trailing_slope(field, size))
    )
    return rows.drop("_day", "_i", "_n")


def future_extremes(bars: DataFrame, field: str, size: int) -> DataFrame:
    rows = _with_day_position(bars).withColumns(
        {"future_high": future_max(field, size), "future_low": future_min(field, size)}
    )
    return rows.drop("_day", "_i", "_n")


def code_of(category: Column) -> Column:
    pairs = [F.lit(v) for item in CATEGORY_CODES.items() for v in item]
    return F.create_map(*pairs)[category]


def category_of(code: Column) -> Column:
    pairs = [F.lit(v) for k, c in CATEGORY_CODES.items() for v in (c, k)]
    return F.create_map(*pairs)[code.cast("int")]


def reversal_labels(
    bars: DataFrame, field: str = "close_sma_5m", rule: ReversalRule = ReversalRule()
) -> DataFrame:
    """Adds ``category, future_highs, future_lows, slopes, mapped_category``.

    A: the past falls faster than the negative slope and the future rises beyond the threshold.
    B: the past rises faster than the positive slope and the future drops beyond the threshold.
    Rows too close to either end of the day are 'C' with null measures. A missing field value is
    replaced by the close first.
    """
    rows = _with_day_position(bars.withColumn(field, F.coalesce(field, "close")))
    longest = max(rule.high_window, rule.low_window)
    decided = (F.col("_i") >= rule.prev_points) & (F.col("_i") <= F.col("_n") - longest)
    rows = rows.withColumns(
        {
            "slopes": F.when(decided, trailing_slope(field, rule.prev_points)),
            "future_highs": F.when(decided, future_max(field, rule.high_window)),
            "future_lows": F.when(decided, future_min(field, rule.low_window)),
        }
    )
    price = F.col(field)
    turn_up = (F.col("slopes") < rule.negative_slope) & (
        F.col("future_highs") > price * (1 + rule.rise)
    )
    turn_down = (F.col("slopes") > rule.positive_slope) & (
        F.col("future_lows") < price * (1 - rule.drop)
    )
    category = F.when(turn_up, "A").when(turn_down, "B").otherwise("C")
    return (
        rows.withColumn("category", category)
        .withColumn("mapped_category", code_of(F.col("category")))
        .drop("_day", "_i", "_n")
    )


def _future_feature(size: int) -> RowFeature:
    """Extremes of the next ``size`` rows of the series, null in its last ``size`` rows."""

    def build(w):
        ahead = w.rowsBetween(1, size)
        full = F.count(F.lit(1)).over(ahead) == size
        return {
            "future_high": F.when(full, F.max("high").over(ahead)),
            "future_low": F.when(full, F.min("low").over(ahead)),
        }

    return RowFeature(size, build)


def future_window_labels(
    bars: DataFrame, grain: str, threshold: float = 0.0003, size: int = 30
) -> DataFrame:
    """Variant without a trend: looks only at the next ``size`` rows of the series."""
    rows = row_features(bars, [_future_feature(size)], grain, ahead=True)
    close = F.col("close")
    category = (
        F.when(F.col("future_high") >= close * (1 + threshold), "A")
        .when(F.col("future_low") <= close * (1 - threshold), "B")
        .otherwise("C")
    )
    return rows.withColumn("category", category)


def sma_trend_labels(
    bars: DataFrame, average: str = "close_sma_20m", threshold: float = 0.0003, size: int = 30
) -> DataFrame:
    """Variant with the trend taken from a moving average, day by day.

    The second rule compares with minus the threshold on the upper side, so it also fires on small
    drops; that sign is kept on purpose.
    """
    rows = _with_day_position(bars)
    ahead = _day_window().rowsBetween(1, size)
    full = F.count(F.lit(1)).over(ahead) == size
    rows = rows.withColumns(
        {
            "future_high": F.when(full, F.max("high").over(ahead)),
            "future_low": F.when(full, F.min("low").over(ahead)),
        }
    )
    close, avg = F.col("close"), F.col(average)
    rise = F.try_divide(F.col("future_high") - close, close)
    fall = F.try_divide(F.col("future_low") - close, close)
    category = (
        F.when((close < avg) & (rise > threshold), "A")
        .when((close > avg) & (fall > -threshold), "B")
        .otherwise("C")
    )
    return rows.withColumns(
        {"close_future_high_diff": rise, "close_future_low_diff": fall, "category": category}
    ).drop("_day", "_i", "_n")


def slope_range_labels(
    bars: DataFrame,
    field: str = "close",
    slope_threshold: float = 0.1,
    rise: float = 0.3,
    low_factor: float = 0.9997,
    prev_points: int = 20,
    size: int = 30,
) -> DataFrame:
    """Variant with the slope of ``field`` and the future range of high and low."""
    rows = _with_day_position(bars)
    decided = (F.col("_i") >= prev_points) & (F.col("_i") <= F.col("_n") - (size + 1))
    rows = rows.withColumns(
        {
            "slope": F.when(decided, trailing_slope(field, prev_points)),
            "future_high": F.when(decided, future_max("high", size)),
            "future_low": F.when(decided, future_min("low", size)),
        }
    )
    close, steep = F.col("close"), slope_threshold
    category = (
        F.when((F.col("slope") < -steep) & (F.col("future_high") > close * (1 + rise)), "A")
        .when((F.col("slope") > steep) & (F.col("future_low") < close * low_factor), "B")
        .otherwise("C")
    )
    return rows.withColumn("category", category).drop("_day", "_i", "_n")
