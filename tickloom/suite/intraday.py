"""Lags, directions, extrema, running day extremes."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.operators import intraday as intra
from tickloom.operators import prep
from tickloom.sources import storage
from tickloom.suite.common import BARS, DAYS, FILLED, MARKET, W, day, filled, minute, register, rounded

QUERIES: dict = {}
UPTO = "OVER (PARTITION BY symbol ORDER BY bar_ts ROWS UNBOUNDED PRECEDING)"
TODAY = "OVER (PARTITION BY symbol, CAST(bar_ts AS DATE) ORDER BY bar_ts ROWS UNBOUNDED PRECEDING)"
DIRECTED = f"""d0 AS (SELECT *, close - lag(close) OVER {W} AS price_change FROM bars),
d1 AS (SELECT *, CASE WHEN price_change > 0 THEN 'up' WHEN price_change < 0 THEN 'down' ELSE 'no change' END
  AS direction FROM d0),
d AS MATERIALIZED (SELECT *, lag(direction) OVER {W} AS prev_direction FROM d1)"""
FIELDS = ["open", "high", "low", "close"]


def _flag(n: int, side: str) -> str:
    frame = f"OVER (PARTITION BY symbol ORDER BY bar_ts ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
    op, agg = (">=", "max") if side == "max" else ("<=", "min")
    return f"coalesce(count(close) {frame} = {n} AND close {op} {agg}(close) {frame}, FALSE)"


SIDES = [(n, s) for n in intra.EXTREMA_WINDOWS for s in ("max", "min")]
FLAGS = ", ".join(f"{_flag(n, s)} AS local_{s}_{n}" for n, s in SIDES)


@register(
    QUERIES,
    f"WITH {BARS} SELECT symbol, bar_ts, "
    + ", ".join(f"lag({f}, {n}) OVER {W} AS {f}_lag_{n}" for n in intra.LAGS for f in FIELDS)
    + " FROM bars",
)
def W13_lags(spark, sf):
    b = minute(spark, sf).select("symbol", "bar_ts", *FIELDS)
    return intra.lags(b, FIELDS, "minute").drop(*FIELDS)


@register(
    QUERIES,
    f"""WITH {BARS}, {DIRECTED} SELECT symbol, bar_ts, round(price_change, 6) AS price_change, direction,
    coalesce(direction = 'down' AND prev_direction = 'up', FALSE) AS direction_change_up_to_down,
    coalesce(direction = 'up' AND prev_direction = 'down', FALSE) AS direction_change_down_to_up FROM d""",
)
def W14_W15_directions(spark, sf):
    b = minute(spark, sf).select("symbol", "bar_ts", "close")
    return rounded(intra.directions(b, "minute").drop("close"))


@register(
    QUERIES,
    f"""WITH {BARS}, {DIRECTED}, c AS (SELECT symbol, bar_ts,
      CAST(count(*) FILTER (direction = 'up') {TODAY} AS BIGINT) AS cumulative_ups,
      CAST(count(*) FILTER (direction = 'down') {TODAY} AS BIGINT) AS cumulative_downs FROM d),
    p AS (SELECT *, lag(cumulative_ups) OVER {W} AS pu, lag(cumulative_downs) OVER {W} AS pd,
      lag(CAST(bar_ts AS DATE)) OVER {W} AS prev_date FROM c),
    q AS (SELECT *, CASE WHEN prev_date = CAST(bar_ts AS DATE) THEN NULL ELSE pu END AS nu,
      CASE WHEN prev_date = CAST(bar_ts AS DATE) THEN NULL ELSE pd END AS nd FROM p)
    SELECT symbol, bar_ts, cumulative_ups, cumulative_downs,
      last_value(nu IGNORE NULLS) {UPTO} AS prev_cumulative_ups,
      last_value(nd IGNORE NULLS) {UPTO} AS prev_cumulative_downs FROM q""",
)
def W16_W17_W31_day_counts(spark, sf):
    b = minute(spark, sf).select("symbol", "bar_ts", "close")
    out = intra.with_day_counts(intra.directions(b, "minute"))
    return out.select(
        "symbol", "bar_ts", "cumulative_ups", "cumulative_downs", "prev_cumulative_ups", "prev_cumulative_downs"
    )


@register(QUERIES, f"WITH {BARS} SELECT symbol, bar_ts, {FLAGS} FROM bars")
def W18_local_extrema(spark, sf):
    b = minute(spark, sf).select("symbol", "bar_ts", "close")
    return intra.local_extrema(b, "minute").drop("close")


@register(
    QUERIES,
    f"""WITH {BARS}, f AS (SELECT symbol, bar_ts, row_number() OVER {W} AS rn, {FLAGS} FROM bars)
    SELECT symbol, bar_ts, """
    + ", ".join(
        f"CAST(count(*) FILTER (local_{s}_{n}) {UPTO} AS BIGINT) AS cumulative_local_{s}_{n}, "
        f"rn - coalesce(max(CASE WHEN local_{s}_{n} THEN rn END) {UPTO}, 1) AS time_since_prev_{s}_{n}"
        for n, s in SIDES
    )
    + " FROM f",
)
def W19_W20_extrema_counts(spark, sf):
    b = minute(spark, sf).select("symbol", "bar_ts", "close")
    flags = [f"local_{s}_{n}" for n, s in SIDES]
    return intra.with_extrema_counts(intra.local_extrema(b, "minute"), "minute").drop("close", *flags)


@register(
    QUERIES,
    f"""WITH {BARS} SELECT symbol, bar_ts,
      max(high) OVER (PARTITION BY symbol, dayofyear(bar_ts) ORDER BY bar_ts ROWS UNBOUNDED PRECEDING) AS max_today,
      min(low) OVER (PARTITION BY symbol, dayofyear(bar_ts) ORDER BY bar_ts ROWS UNBOUNDED PRECEDING) AS min_today,
      max(high) OVER (PARTITION BY symbol, dayofyear(bar_ts), {MARKET} ORDER BY bar_ts ROWS UNBOUNDED PRECEDING) AS max_today_session,
      min(low) OVER (PARTITION BY symbol, dayofyear(bar_ts), {MARKET} ORDER BY bar_ts ROWS UNBOUNDED PRECEDING) AS min_today_session
    FROM bars""",
)
def W21_W22_day_extremes(spark, sf):
    b = prep.with_market_open(minute(spark, sf).select("symbol", "bar_ts", "high", "low"))
    return intra.with_day_extremes(b).drop("high", "low", "market_open")


@register(
    QUERIES,
    f"""WITH {DAYS} SELECT symbol, bar_ts,
      max(high) OVER (PARTITION BY symbol, dayofyear(bar_ts) ORDER BY bar_ts ROWS UNBOUNDED PRECEDING) AS max_today,
      min(low) OVER (PARTITION BY symbol, dayofyear(bar_ts) ORDER BY bar_ts ROWS UNBOUNDED PRECEDING) AS min_today
    FROM days""",
)
def W21_day_extremes_over_years(spark, sf):
    b = prep.with_market_open(day(spark, sf).select("symbol", "bar_ts", "high", "low"))
    return intra.with_day_extremes(b).select("symbol", "bar_ts", "max_today", "min_today")


@register(
    QUERIES,
    f"""WITH {BARS}, {DIRECTED} SELECT symbol, CAST(CAST(bar_ts AS DATE) AS VARCHAR) AS date,
    CAST(count(*) FILTER (direction IS DISTINCT FROM prev_direction AND direction <> 'no change') AS BIGINT)
      AS daily_direction_changes FROM d GROUP BY 1, 2""",
)
def A5_daily_direction_changes(spark, sf):
    b = minute(spark, sf).select("symbol", "bar_ts", "close")
    out = intra.daily_direction_changes(b, "minute")
    return out.withColumn("date", F.col("date").cast("string"))


@register(
    QUERIES,
    f"""WITH {BARS}, {DIRECTED} SELECT symbol, bar_ts, direction = 'no change' AS "no change",
    direction = 'up' AS up FROM d""",
)
def H16_one_hot_direction(spark, sf):
    b = minute(spark, sf).select("symbol", "bar_ts", "close")
    return intra.one_hot_direction(intra.directions(b, "minute")).select("symbol", "bar_ts", "no change", "up")


_LAGS = ", ".join(f"lag({f}, {n}) OVER (PARTITION BY d.symbol ORDER BY bar_ts) AS {f}_lag_{n}" for n in intra.LAGS for f in FIELDS)
_SO_FAR = "OVER (PARTITION BY d.symbol ORDER BY bar_ts ROWS UNBOUNDED PRECEDING)"
_THIS_DAY = "OVER (PARTITION BY d.symbol, CAST(bar_ts AS DATE) ORDER BY bar_ts ROWS UNBOUNDED PRECEDING)"
_YEAR_DAY = "OVER (PARTITION BY d.symbol, dayofyear(bar_ts){} ORDER BY bar_ts ROWS UNBOUNDED PRECEDING)"
_COUNTS = ", ".join(
    f"local_{s}_{n}, CAST(count(*) FILTER (local_{s}_{n}) {_SO_FAR} AS BIGINT) AS cumulative_local_{s}_{n}, "
    f"rn - coalesce(max(CASE WHEN local_{s}_{n} THEN rn END) {_SO_FAR}, 1) AS time_since_prev_{s}_{n}"
    for n, s in SIDES
)
_EXTREMES = ", ".join(
    f"{agg}({c}) {_YEAR_DAY.format(by)} AS {agg}_today{name}"
    for agg, c in (("max", "high"), ("min", "low"))
    for by, name in (("", ""), (", market_open", "_session"))
)


@register(
    QUERIES,
    f"""WITH {FILLED},
    d0 AS (SELECT *, close - lag(close) OVER {W} AS price_change FROM filled),
    d1 AS (SELECT *, CASE WHEN price_change > 0 THEN 'up' WHEN price_change < 0 THEN 'down' ELSE 'no change' END AS direction FROM d0),
    d AS (SELECT *, lag(direction) OVER {W} AS prev_direction, row_number() OVER {W} AS rn, {FLAGS} FROM d1),
    finals AS (SELECT symbol, CAST(bar_ts AS DATE) AS dt, count(*) FILTER (direction = 'up') AS ups,
      count(*) FILTER (direction = 'down') AS downs FROM d GROUP BY 1, 2),
    prev AS (SELECT symbol, dt, lag(ups) OVER (PARTITION BY symbol ORDER BY dt) AS prev_cumulative_ups,
      lag(downs) OVER (PARTITION BY symbol ORDER BY dt) AS prev_cumulative_downs FROM finals)
    SELECT d.symbol, d.bar_ts, open, high, low, close, volume, trade_count, round(vwap, 6) AS vwap, market_open, {_LAGS},
      round(price_change, 6) AS price_change,
      coalesce(direction = 'down' AND prev_direction = 'up', FALSE) AS direction_change_up_to_down,
      coalesce(direction = 'up' AND prev_direction = 'down', FALSE) AS direction_change_down_to_up, {_COUNTS},
      CAST(count(*) FILTER (direction = 'up') {_THIS_DAY} AS BIGINT) AS cumulative_ups,
      CAST(count(*) FILTER (direction = 'down') {_THIS_DAY} AS BIGINT) AS cumulative_downs,
      prev_cumulative_ups, prev_cumulative_downs, {_EXTREMES},
      CAST(hour(bar_ts) AS INTEGER) AS hour, CAST(minute(bar_ts) AS INTEGER) AS minute,
      CAST(dayofyear(bar_ts) AS INTEGER) AS day_of_year, direction = 'no change' AS "no change", direction = 'up' AS up
    FROM d JOIN prev ON prev.symbol = d.symbol AND prev.dt = CAST(bar_ts AS DATE)""",
)
def W13_W22_custom_features(spark, sf):
    """All custom features over the minute-filled series, every column."""
    return rounded(intra.custom_features(storage.stage(filled(spark, sf)), FIELDS), 6, ["vwap", "price_change"])
