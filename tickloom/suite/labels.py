"""Trend slopes, future extremes, reversal labels and their variants."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.operators import evaluate
from tickloom.operators import indicators as ind
from tickloom.operators import labels as lab
from tickloom.operators import prep
from tickloom.plans.sliding import Extreme, Slope, sliding
from tickloom.sources import storage
from tickloom.suite.common import BARS, FILLED, filled, minute, register, rounded

QUERIES: dict = {}
DAY_POS = """(SELECT *, row_number() OVER (PARTITION BY symbol, CAST(bar_ts AS DATE) ORDER BY bar_ts) - 1 AS i,
  count(*) OVER (PARTITION BY symbol, CAST(bar_ts AS DATE)) AS n FROM {source})"""


def _day(lo: str, hi: str) -> str:
    return f"OVER (PARTITION BY symbol, CAST(bar_ts AS DATE) ORDER BY bar_ts ROWS BETWEEN {lo} AND {hi})"


def _sma(field: str, n: int) -> str:
    f = f"OVER (PARTITION BY symbol ORDER BY bar_ts ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count({field}) {f} = {n} THEN avg({field}) {f} END"


def _slope(field: str, n: int) -> str:
    return f"(floor(regr_slope({field}, i) {_day(f'{n} PRECEDING', '1 PRECEDING')} * 1e9 + 0.5) / 1e9)"


AHEAD30 = _day("1 FOLLOWING", "30 FOLLOWING")


def _reversal(source: str) -> str:
    """Production labels over a source with ``close_sma_5m``; adds CTEs p, m and lab."""
    return f"""p AS (SELECT * REPLACE (coalesce(close_sma_5m, close) AS close_sma_5m),
      row_number() OVER (PARTITION BY symbol, CAST(bar_ts AS DATE) ORDER BY bar_ts) - 1 AS i,
      count(*) OVER (PARTITION BY symbol, CAST(bar_ts AS DATE)) AS n FROM {source}),
    m AS (SELECT *, CASE WHEN i >= 11 AND i <= n - 30 THEN {_slope('close_sma_5m', 11)} END AS slopes,
      CASE WHEN i >= 11 AND i <= n - 30 THEN max(close_sma_5m) {AHEAD30} END AS future_highs,
      CASE WHEN i >= 11 AND i <= n - 30 THEN min(close_sma_5m) {AHEAD30} END AS future_lows FROM p),
    lab AS MATERIALIZED (SELECT *, CASE
      WHEN slopes < -0.026 AND future_highs > close_sma_5m * (1 + 0.0007::DOUBLE) THEN 'A'
      WHEN slopes > 0.013 AND future_lows < close_sma_5m * (1 - 0.0012::DOUBLE) THEN 'B' ELSE 'C' END AS category FROM m)"""


SMA5 = f"sma AS MATERIALIZED (SELECT *, {_sma('close', 5)} AS close_sma_5m FROM bars)"


def averaged(spark, sf, windows=(5,)):
    b = minute(spark, sf).select("symbol", "bar_ts", "open", "high", "low", "close")
    return ind.simple_averages(b, ["close"], list(windows), "minute")


def reversal(spark, sf):
    return lab.reversal_labels(averaged(spark, sf))


@register(
    QUERIES,
    f"""WITH {BARS} SELECT symbol, bar_ts, CASE WHEN i >= 20 THEN round({_slope('close', 20)}, 6) END AS slope
    FROM {DAY_POS.format(source='bars')}""",
)
def W23_trailing_slope(spark, sf):
    b = minute(spark, sf).select("symbol", "bar_ts", "close")
    return rounded(lab.trailing_slopes(b, "close", 20).drop("close"))


@register(
    QUERIES,
    f"""WITH {BARS} SELECT symbol, bar_ts, max(close) {AHEAD30} AS future_high, min(close) {AHEAD30} AS future_low
    FROM bars""",
)
def W24_future_extremes(spark, sf):
    b = minute(spark, sf).select("symbol", "bar_ts", "close")
    return lab.future_extremes(b, "close", 30).drop("close")


@register(
    QUERIES,
    f"""WITH {BARS}, {SMA5}, {_reversal('sma')}
    SELECT symbol, bar_ts, round(close_sma_5m, 6) AS close_sma_5m, round(slopes, 6) AS slopes,
      round(future_highs, 6) AS future_highs, round(future_lows, 6) AS future_lows, category,
      CASE category WHEN 'A' THEN 0 WHEN 'B' THEN 1 ELSE 2 END AS mapped_category FROM lab""",
)
def W25_W26_reversal_labels(spark, sf):
    out = reversal(spark, sf).select(
        "symbol", "bar_ts", "close_sma_5m", "slopes", "future_highs", "future_lows", "category", "mapped_category"
    )
    return rounded(out)


@register(
    QUERIES,
    f"""WITH {BARS}, f AS (SELECT *, count(*) OVER w AS n, max(high) OVER w AS fh, min(low) OVER w AS fl FROM bars
      WINDOW w AS (PARTITION BY symbol ORDER BY bar_ts ROWS BETWEEN 1 FOLLOWING AND 30 FOLLOWING)),
    g AS (SELECT symbol, bar_ts, close, CASE WHEN n = 30 THEN fh END AS future_high,
      CASE WHEN n = 30 THEN fl END AS future_low FROM f)
    SELECT symbol, bar_ts, future_high, future_low, CASE WHEN future_high >= close * (1 + 0.0003::DOUBLE) THEN 'A'
      WHEN future_low <= close * (1 - 0.0003::DOUBLE) THEN 'B' ELSE 'C' END AS category FROM g""",
)
def W27_future_window_labels(spark, sf):
    b = minute(spark, sf).select("symbol", "bar_ts", "high", "low", "close")
    return lab.future_window_labels(b, "minute").drop("high", "low", "close")


SMA_TREND = f"""s20 AS (SELECT *, {_sma('close', 20)} AS close_sma_20m FROM bars),
    h AS (SELECT *, count(*) {AHEAD30} AS k, max(high) {AHEAD30} AS fh, min(low) {AHEAD30} AS fl FROM s20),
    j AS (SELECT *, CASE WHEN k = 30 AND close <> 0 THEN (fh - close) / close END AS up,
      CASE WHEN k = 30 AND close <> 0 THEN (fl - close) / close END AS dn FROM h),
    trend AS MATERIALIZED (SELECT symbol, bar_ts, up, dn, CASE WHEN close < close_sma_20m AND up > 0.0003 THEN 'A'
      WHEN close > close_sma_20m AND dn > -0.0003 THEN 'B' ELSE 'C' END AS category FROM j)"""


def sma_trend(spark, sf):
    return lab.sma_trend_labels(averaged(spark, sf, (20,)))


@register(
    QUERIES,
    f"""WITH {BARS}, {SMA_TREND} SELECT symbol, bar_ts, round(up, 6) AS close_future_high_diff,
    round(dn, 6) AS close_future_low_diff, category FROM trend""",
)
def W28_sma_trend_labels(spark, sf):
    out = sma_trend(spark, sf)
    return rounded(out.select("symbol", "bar_ts", "close_future_high_diff", "close_future_low_diff", "category"))


@register(
    QUERIES,
    f"""WITH {BARS}, m AS (SELECT *, CASE WHEN i >= 20 AND i <= n - 31 THEN {_slope('close', 20)} END AS slope,
      CASE WHEN i >= 20 AND i <= n - 31 THEN max(high) {AHEAD30} END AS future_high,
      CASE WHEN i >= 20 AND i <= n - 31 THEN min(low) {AHEAD30} END AS future_low
      FROM {DAY_POS.format(source='bars')})
    SELECT symbol, bar_ts, round(slope, 6) AS slope, future_high, future_low,
      CASE WHEN slope < -0.1 AND future_high > close * (1 + 0.3::DOUBLE) THEN 'A'
      WHEN slope > 0.1 AND future_low < close * 0.9997 THEN 'B' ELSE 'C' END AS category FROM m""",
)
def W29_slope_range_labels(spark, sf):
    b = minute(spark, sf).select("symbol", "bar_ts", "high", "low", "close")
    return rounded(lab.slope_range_labels(b).drop("high", "low", "close"), 6, ["slope"])


@register(
    QUERIES,
    f"WITH {BARS}, {SMA5}, {_reversal('sma')} SELECT category, bar_ts >= TIMESTAMP '2024-01-16' AS after_cutoff, "
    "count(*) AS rows FROM lab GROUP BY 1, 2",
)
def A6_class_counts(spark, sf):
    out = reversal(spark, sf).withColumn(
        "after_cutoff", F.col("bar_ts") >= F.lit("2024-01-16").cast("timestamp_ntz")
    )
    return evaluate.class_counts(out, by=["after_cutoff"])


FLAGSHIP_SQL = f"""WITH {FILLED}, org AS (SELECT symbol, CAST(CAST(min(bar_ts) AS DATE) AS TIMESTAMP) AS o FROM filled GROUP BY 1),
    half AS (SELECT b.symbol, time_bucket(INTERVAL '30 minutes', b.bar_ts, org.o) AS bar_ts,
      arg_min(open, b.bar_ts) AS open, max(high) AS high, min(low) AS low, arg_max(close, b.bar_ts) AS close
      FROM filled b JOIN org ON org.symbol = b.symbol GROUP BY 1, 2),
    kept AS (SELECT * FROM half h WHERE EXISTS (SELECT 1 FROM filled s WHERE s.symbol = h.symbol AND s.bar_ts = h.bar_ts)),
    sma AS MATERIALIZED (SELECT *, {_sma('close', 5)} AS close_sma_5m FROM kept), {_reversal('sma')}
    SELECT symbol, category, count(*) AS rows FROM lab GROUP BY 1, 2"""


@register(QUERIES, FLAGSHIP_SQL)
def bars_to_class_counts(spark, sf):
    """Events to minute bars, filled, resampled to 30 minutes, averaged, labelled, counted."""
    half = prep.resample(filled(spark, sf).drop("vwap", "market_open"), 30)
    averaged_half = ind.simple_averages(half, ["close"], [5], "minute")
    return evaluate.class_counts(lab.reversal_labels(averaged_half), by=["symbol"])


@register(
    QUERIES,
    f"""WITH {FILLED}, sma AS MATERIALIZED (SELECT *, {_sma('close', 5)} AS close_sma_5m FROM filled), {_reversal('sma')}
    SELECT symbol, CAST(CAST(bar_ts AS DATE) AS VARCHAR) AS date, category, count(*) AS rows FROM lab GROUP BY 1, 2, 3""",
)
def W25_filled_label_counts(spark, sf):
    b = filled(spark, sf).select("symbol", "bar_ts", "open", "high", "low", "close")
    out = lab.reversal_labels(ind.simple_averages(b, ["close"], [5], "minute"))
    return evaluate.class_counts(out.withColumn("date", F.to_date("bar_ts").cast("string")), by=["symbol", "date"])


# -- wide frames ----------------------------------------------------------------------------

#: Rows of a session and of five of them.
_WIDE = [390, 1950]


def _wide_sql(agg: str, field: str, lo: str, hi: str, n: int) -> str:
    w = f"OVER (PARTITION BY symbol ORDER BY bar_ts ROWS BETWEEN {lo} AND {hi})"
    return f"CASE WHEN count({field}) {w} = {n} THEN {agg}({field}) {w} END"


_WIDE_COLUMNS = ", ".join(
    f"{_wide_sql('max', 'close', f'{n} PRECEDING', '1 PRECEDING', n)} AS prior_max_{n}, {_wide_sql('min', 'close', f'{n} PRECEDING', '1 PRECEDING', n)} AS prior_min_{n}, "
    f"{_wide_sql('max', 'high', '1 FOLLOWING', f'{n} FOLLOWING', n)} AS future_high_{n}, {_wide_sql('min', 'low', '1 FOLLOWING', f'{n} FOLLOWING', n)} AS future_low_{n}"
    for n in _WIDE
)


@register(
    QUERIES,
    f"""WITH {FILLED}, wide AS (SELECT symbol, bar_ts, close, {_WIDE_COLUMNS} FROM filled)
    SELECT *, coalesce(close >= prior_max_1950, FALSE) AS local_max_1950, coalesce(close <= prior_min_1950, FALSE) AS local_min_1950 FROM wide""",
)
def W18_W24_W27_wide_extremes(spark, sf):
    """Extremes of the session and of the week before and after each filled minute."""
    rows = storage.stage(filled(spark, sf).select("symbol", "bar_ts", "close", "high", "low"), "filled")
    frames = []
    for n in _WIDE:
        frames += [Extreme("close", f"prior_{side}_{n}", -n, -1, side == "max", n) for side in ("max", "min")]
        frames += [Extreme("high", f"future_high_{n}", 1, n, True, n), Extreme("low", f"future_low_{n}", 1, n, False, n)]
    out = sliding(rows, frames, "minute").drop("high", "low")
    beyond = {"local_max_1950": F.col("close") >= F.col("prior_max_1950"), "local_min_1950": F.col("close") <= F.col("prior_min_1950")}
    return out.withColumns({name: F.coalesce(cond, F.lit(False)) for name, cond in beyond.items()})


_SLOPE_ROWS = [30, 120, 390]
_SLOPE_COLUMNS = ", ".join(f"CASE WHEN i >= {n} THEN round(regr_slope(close, i) {_day(f'{n} PRECEDING', '1 PRECEDING')}, 6) END AS slope_{n}" for n in _SLOPE_ROWS)


@register(QUERIES, f"WITH {FILLED} SELECT symbol, bar_ts, {_SLOPE_COLUMNS} FROM {DAY_POS.format(source='filled')}")
def W23_W25_W29_wide_slopes(spark, sf):
    """Slopes of the rows before each filled minute, up to a session's, inside the day."""
    rows = filled(spark, sf).select("symbol", "bar_ts", "close")
    return rounded(sliding(rows, [Slope("close", f"slope_{n}", -n, -1) for n in _SLOPE_ROWS], "minute", by_day=True).drop("close"))
