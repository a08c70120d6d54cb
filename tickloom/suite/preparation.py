"""Checks, filling and resampling of bars."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions import times
from tickloom.functions.names import split_duration
from tickloom.operators import prep
from tickloom.sources import sessions, storage
from tickloom.suite.common import BARS, DAYS, FILLED, HOURS, day, filled, hour, minute, register, rounded, table

QUERIES: dict = {}
MIN_COLS = "open, high, low, close, volume, trade_count, market_open"


def _resample_sql(source: str, ctes: str, width: int, aligned: bool = True) -> str:
    """Origin-anchored bins, kept when the bin's left edge is a source bar."""
    semi = (
        f"WHERE EXISTS (SELECT 1 FROM {source} s WHERE s.symbol = r.symbol AND s.bar_ts = r.bar_ts)"
        if aligned
        else ""
    )
    return f"""WITH {ctes}, org AS (SELECT symbol, CAST(CAST(min(bar_ts) AS DATE) AS TIMESTAMP) AS o FROM {source} GROUP BY 1),
    r AS (SELECT b.symbol, time_bucket(INTERVAL '{width} minutes', b.bar_ts, org.o) AS bar_ts,
      first(open ORDER BY b.bar_ts) AS open, max(high) AS high, min(low) AS low,
      last(close ORDER BY b.bar_ts) AS close, sum(volume) AS volume, sum(trade_count) AS trade_count,
      bool_or(hour(b.bar_ts) * 60 + minute(b.bar_ts) BETWEEN 570 AND 959) AS market_open
      FROM {source} b JOIN org ON org.symbol = b.symbol GROUP BY 1, 2)
    SELECT symbol, bar_ts, {MIN_COLS} FROM r {semi}"""


def _days_sql(days: int) -> str:
    return f"""WITH {DAYS}, org AS (SELECT symbol, min(bar_ts) AS o, max(bar_ts) AS hi FROM days GROUP BY 1),
    grid AS (SELECT symbol, unnest(generate_series(o, hi, INTERVAL '{days} days')) AS bar_ts FROM org),
    r AS (SELECT d.symbol, time_bucket(INTERVAL '{days} days', d.bar_ts, org.o) AS bar_ts,
      first(open ORDER BY d.bar_ts) AS open, max(high) AS high, min(low) AS low,
      last(close ORDER BY d.bar_ts) AS close, sum(volume) AS volume
      FROM days d JOIN org ON org.symbol = d.symbol GROUP BY 1, 2)
    SELECT grid.symbol, grid.bar_ts, open, high, low, close, round(coalesce(volume, 0), 3) AS volume
    FROM grid LEFT JOIN r ON r.symbol = grid.symbol AND r.bar_ts = grid.bar_ts"""


@register(
    QUERIES,
    f"""WITH {BARS} SELECT count(*) AS rows, count(*) FILTER (open IS NULL) AS open_missing,
    count(*) FILTER (high IS NULL) AS high_missing, count(*) FILTER (low IS NULL) AS low_missing,
    count(*) FILTER (close IS NULL) AS close_missing FROM bars""",
)
def P16_missing_prices(spark, sf):
    return prep.null_price_counts(minute(spark, sf))


@register(
    QUERIES,
    """SELECT event_type AS symbol, date_trunc('minute', ts) AS bar_ts, count(*) AS copies
    FROM events GROUP BY 1, 2 HAVING count(*) > 1""",
)
def P17_duplicate_minutes(spark, sf):
    raw = table(spark, sf, "events").select(
        F.col("event_type").alias("symbol"), times.floor_minute(F.col("ts")).alias("bar_ts")
    )
    return prep.duplicate_bars(raw)


@register(
    QUERIES,
    """SELECT CASE WHEN user_id % 7 = 0 AND event_id % 11 = 0 THEN 'symbol,bar_ts' WHEN user_id % 7 = 0 THEN 'symbol'
      WHEN event_id % 11 = 0 THEN 'bar_ts' ELSE 'none' END AS missing, count(*) AS rows FROM events GROUP BY 1""",
)
def P16_rows_without_keys(spark, sf):
    """Every row is either kept or set aside with the reason."""
    raw = table(spark, sf, "events").select(
        F.when(F.col("user_id") % 7 != 0, F.col("event_type")).alias("symbol"), F.when(F.col("event_id") % 11 != 0, F.col("ts")).alias("bar_ts")
    )
    aside = prep.unkeyed(raw).select("missing")
    kept = prep.keyed(raw).select(F.lit("none").alias("missing"))
    return aside.unionByName(kept).groupBy("missing").agg(F.count(F.lit(1)).alias("rows"))


@register(
    QUERIES,
    f"""WITH {BARS} SELECT symbol, CAST(CAST(bar_ts AS DATE) AS VARCHAR) AS date, min(bar_ts) AS first_ts,
    max(bar_ts) AS last_ts FROM bars GROUP BY 1, 2""",
)
def A9_day_bounds(spark, sf):
    b = minute(spark, sf)
    return b.groupBy("symbol", F.to_date("bar_ts").cast("string").alias("date")).agg(
        F.min("bar_ts").alias("first_ts"), F.max("bar_ts").alias("last_ts")
    )


@register(
    QUERIES,
    f"""WITH {FILLED} SELECT symbol, bar_ts, open, high, low, close, volume, trade_count,
    round(vwap, 6) AS vwap, market_open FROM filled""",
)
def J4_fill_minutes(spark, sf):
    return rounded(filled(spark, sf), 6, ["vwap"])


@register(
    QUERIES,
    f"""WITH {FILLED} SELECT f.symbol, f.bar_ts, f.close,
    CASE WHEN b.bar_ts IS NULL THEN 0 ELSE f.volume END AS volume,
    CASE WHEN b.bar_ts IS NULL THEN 0 ELSE f.trade_count END AS trade_count
    FROM filled f LEFT JOIN bars b ON b.symbol = f.symbol AND b.bar_ts = f.bar_ts""",
)
def J4_fill_minutes_zero_volume(spark, sf):
    out = prep.fill_minutes(minute(spark, sf), zero_volume=True)
    return out.select("symbol", "bar_ts", "close", "volume", "trade_count")


@register(QUERIES, _resample_sql("filled", FILLED, 30))
def A1_J1_resample_30min(spark, sf):
    return prep.resample(filled(spark, sf).drop("vwap"), 30)


@register(QUERIES, _resample_sql("filled", FILLED, 25))
def A1_H8_resample_25min(spark, sf):
    return prep.resample(filled(spark, sf).drop("vwap"), 25)


@register(QUERIES, _resample_sql("bars", BARS, 5))
def A1_resample_5min_sparse(spark, sf):
    return prep.resample(prep.with_market_open(minute(spark, sf)).drop("vwap"), 5)


@register(QUERIES, _resample_sql("bars", BARS, 15, aligned=False))
def A1_resample_15min_unaligned(spark, sf):
    return prep.resample(prep.with_market_open(minute(spark, sf)).drop("vwap"), 15, keep_unaligned=True)


@register(QUERIES, _resample_sql("hours", HOURS, 120))
def A2_resample_120min(spark, sf):
    return prep.resample(prep.with_market_open(hour(spark, sf)).drop("vwap"), 120)


@register(QUERIES, _resample_sql("hours", HOURS, 180))
def A2_resample_180min(spark, sf):
    return prep.resample(prep.with_market_open(hour(spark, sf)).drop("vwap"), 180)


@register(QUERIES, _resample_sql("hours", HOURS, 240))
def A2_resample_240min(spark, sf):
    return prep.resample(prep.with_market_open(hour(spark, sf)).drop("vwap"), 240)


_DAY_LENGTHS = [split_duration(d)[0] for d in prep.DAY_DURATIONS]


@register(
    QUERIES,
    "SELECT * FROM (" + ") UNION ALL SELECT * FROM (".join(f"SELECT '{n}D' AS duration, * FROM ({_days_sql(n)})" for n in _DAY_LENGTHS) + ")",
)
def A3_all_day_durations(spark, sf):
    """Every length of several days."""
    parts = [prep.resample_days(day(spark, sf), n).select(F.lit(f"{n}D").alias("duration"), "*") for n in _DAY_LENGTHS]
    return rounded(functools.reduce(DataFrame.unionByName, parts), 3, ["volume"])


@register(QUERIES, _days_sql(2))
def A3_resample_2days(spark, sf):
    return rounded(prep.resample_days(day(spark, sf), 2), 3, ["volume"])


@register(QUERIES, _days_sql(30))
def A3_resample_30days(spark, sf):
    return rounded(prep.resample_days(day(spark, sf), 30), 3, ["volume"])


@register(
    QUERIES,
    f"""WITH {BARS} SELECT symbol, CAST(CAST(bar_ts AS DATE) AS VARCHAR) AS date,
    first(open ORDER BY bar_ts) AS open, last(close ORDER BY bar_ts) AS close, max(high) AS high,
    min(low) AS low FROM bars GROUP BY 1, 2""",
)
def A4_daily_from_minutes(spark, sf):
    return prep.daily_from_minutes(minute(spark, sf)).withColumn("date", F.col("date").cast("string"))


_ALL = [2, 3, 5, 10, 15, 20, 25, 30]


@register(
    QUERIES,
    f"""WITH {FILLED}, org AS (SELECT symbol, CAST(CAST(min(bar_ts) AS DATE) AS TIMESTAMP) AS o FROM filled GROUP BY 1),
    widths AS (SELECT unnest({_ALL}) AS w),
    r AS (SELECT b.symbol, w || 'min' AS duration,
      time_bucket(to_minutes(w), b.bar_ts, org.o) AS bar_ts,
      arg_min(open, b.bar_ts) AS open, max(high) AS high, min(low) AS low,
      arg_max(close, b.bar_ts) AS close, sum(volume) AS volume, sum(trade_count) AS trade_count,
      bool_or(market_open) AS market_open
      FROM filled b JOIN org ON org.symbol = b.symbol, widths GROUP BY 1, 2, 3)
    SELECT symbol, duration, bar_ts, {MIN_COLS} FROM r
    WHERE EXISTS (SELECT 1 FROM filled s WHERE s.symbol = r.symbol AND s.bar_ts = r.bar_ts)""",
)
def A1_S11_all_minute_durations(spark, sf):
    """Every minute-family bar length in one pass."""
    return prep.resample_many(filled(spark, sf).drop("vwap"), _ALL)


@register(
    QUERIES,
    f"""WITH {HOURS}, e AS (SELECT * REPLACE (CAST(bar_ts AT TIME ZONE 'UTC' AT TIME ZONE 'America/New_York' AS TIMESTAMP) AS bar_ts) FROM hours)
    SELECT symbol, bar_ts, close, (hour(bar_ts) * 60 + minute(bar_ts) BETWEEN 570 AND 959) AS market_open FROM e""",
)
def H7_P11_localized_hours(spark, sf):
    raw = hour(spark, sf).withColumnRenamed("bar_ts", "timestamp")
    out = prep.with_market_open(prep.localize(raw))
    return out.select("symbol", "bar_ts", "close", "market_open")


@register(
    QUERIES,
    """SELECT strftime(d, '%Y-%m-%d') AS date, '09:30' AS open, '16:00' AS close,
      strftime(d + CASE WHEN isodow(d) = 5 THEN INTERVAL 3 DAY ELSE INTERVAL 1 DAY END, '%Y-%m-%d') AS settlement_date
    FROM (SELECT unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS d
      FROM (SELECT date_trunc('day', min(ts)) AS lo, date_trunc('day', max(ts)) AS hi FROM events))
    WHERE isodow(d) < 6""",
)
def S10_calendar(spark, sf):
    span = table(spark, sf, "events").agg(
        F.to_date(F.min("ts")).cast("string").alias("lo"), F.to_date(F.max("ts")).cast("string").alias("hi")
    ).first()
    calendar = storage.trading_calendar(spark, span["lo"], span["hi"])
    path = storage.write_csv(calendar, storage.new_folder(spark, "calendar"))
    back = spark.read.option("header", True).schema(
        "date string, open string, close string, session_open string, session_close string, settlement_date string"
    ).csv(path)
    return back.select("date", "open", "close", "settlement_date")


#: A holiday without a session, and a half day.
_HOLIDAY, _HALF_DAY, _HALF_CLOSE = "2024-01-15", "2024-01-24", "13:00"


@register(
    QUERIES,
    f"""WITH {FILLED}, timed AS (SELECT symbol, bar_ts, CAST(bar_ts AS DATE) AS d, hour(bar_ts) * 60 + minute(bar_ts) AS m FROM filled),
    held AS (SELECT *, isodow(d) < 6 AND d <> DATE '{_HOLIDAY}' AS trades, CASE WHEN d = DATE '{_HALF_DAY}' THEN 780 ELSE 960 END AS closes,
      CASE WHEN d = DATE '{_HALF_DAY}' THEN 780 ELSE 1200 END AS ends FROM timed)
    SELECT symbol, bar_ts, trades AND m >= 570 AND m < closes AS market_open, trades AND m >= 240 AND m < ends AS extended_open FROM held""",
)
def S10_P11_landed_sessions(spark, sf):
    """Sessions of filled minutes from a calendar that was landed as text, with a holiday and a half day, and stored."""
    span = table(spark, sf, "events").agg(F.to_date(F.min("ts")).cast("string").alias("lo"), F.to_date(F.max("ts")).cast("string").alias("hi")).first()
    exceptions = spark.createDataFrame([(_HOLIDAY, None), (_HALF_DAY, _HALF_CLOSE)], "date string, close string").withColumn("date", F.col("date").cast("date"))
    landed = sessions.with_exceptions(storage.trading_calendar(spark, span["lo"], span["hi"]), exceptions)
    path = storage.write_csv(landed, storage.new_folder(spark, "calendar") + ".csv")
    root = storage.new_folder(spark, "sessions")
    sessions.store(storage.read_table(spark, path, schema=sessions.SCHEMA), root)
    bars = prep.fill_minutes(minute(spark, sf)).select("symbol", "bar_ts")
    return sessions.with_sessions(bars, sessions.read(spark, root))


@register(
    QUERIES,
    """WITH o AS (SELECT o_orderpriority, o_orderdate, row_number() OVER (ORDER BY o_orderkey) - 1 AS place,
      max(o_orderdate) OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS latest FROM orders)
    SELECT o_orderpriority, count(*) AS rows, count(*) FILTER (o_orderdate < latest) AS out_of_order, min(place) FILTER (o_orderdate < latest) AS first_row,
      arg_min(o_orderdate, place) FILTER (o_orderdate < latest) AS first_ts, arg_min(latest, place) FILTER (o_orderdate < latest) AS after_ts FROM o GROUP BY 1""",
)
def P17_order_as_stored(spark, sf):
    """Of each priority of the stored orders, which aren't in time order: the first row that breaks it, by its place in the file."""
    return prep.disordered(spark.read.parquet(f"{sf}/orders.parquet"), "o_orderpriority", "o_orderdate", run=4096).drop("file")
