"""Projections, filters, set operations, sorts and scalar functions on the given tables."""

from __future__ import annotations

import functools

from pyspark.sql import functions as F

from tickloom.functions import names, times
from tickloom.operators import assemble, evaluate
from tickloom.sources import catalog, storage
from tickloom.suite.common import BARS, DAYS, MARKET, day, minute, register, rounded, table, rnd

QUERIES: dict = {}
OHLC = "open, high, low, close"


@register(QUERIES, "SELECT o_orderkey, o_totalprice, o_orderdate FROM orders")
def S1_P1_pruned_scan(spark, sf):
    return storage.read_table(
        spark, f"{sf}/orders.parquet", ["o_orderkey", "o_totalprice", "o_orderdate"]
    )


@register(
    QUERIES,
    f"WITH {DAYS} SELECT symbol, bar_ts, {OHLC}, round(volume, 4) AS volume, trade_count FROM days",
)
def S9_day_bars(spark, sf):
    return rounded(day(spark, sf), 4, ["volume"])


@register(
    QUERIES,
    f"WITH {BARS} SELECT symbol, bar_ts, {OHLC}, volume, trade_count, round(vwap, 6) AS vwap FROM bars",
)
def S9_minute_bars(spark, sf):
    return rounded(minute(spark, sf), 6, ["vwap"])


@register(
    QUERIES,
    f"WITH {BARS} SELECT symbol, bar_ts, open, close, round(vwap, 6) AS vwap_price FROM bars",
)
def P2_P3_P5_columns_by_name(spark, sf):
    b = minute(spark, sf).withColumnsRenamed({"vwap": "vwap_price"})
    kept = names.columns_with(b.columns, "symbol", "bar_ts", "open", "close", "vwap")
    extra = names.columns_without(b.columns, *kept)
    return rounded(b.drop(*extra), 6, ["vwap_price"])


@register(QUERIES, "SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders")
def P4_drop_text_columns(spark, sf):
    return assemble.drop_text_columns(table(spark, sf, "orders"))


@register(QUERIES, "SELECT event_id, ts, value FROM events WHERE event_type = 'click'")
def P6_one_series(spark, sf):
    e = table(spark, sf, "events")
    return e.where(F.col("event_type") == "click").select("event_id", "ts", "value")


@register(
    QUERIES,
    "SELECT event_type, count(*) AS n, round(sum(value), 4) AS total FROM events "
    "WHERE event_type IN ('click', 'view') GROUP BY 1",
)
def P7_series_list(spark, sf):
    e = table(spark, sf, "events").where(F.col("event_type").isin("click", "view"))
    return e.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), rnd(F.sum("value"), 4).alias("total")
    )


@register(QUERIES, "SELECT event_id, ts, value FROM events WHERE ts < TIMESTAMP '2024-01-10'")
def P8_before_cutoff(spark, sf):
    e = table(spark, sf, "events")
    return e.where(F.col("ts") < F.lit("2024-01-10").cast("timestamp_ntz")).select("event_id", "ts", "value")


@register(
    QUERIES,
    "SELECT event_id, ts, value FROM events "
    "WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-07'",
)
def P9_inclusive_date_slice(spark, sf):
    e = table(spark, sf, "events")
    return e.where(times.in_date_slice(F.col("ts"), "2024-01-05", "2024-01-07")).select("event_id", "ts", "value")


@register(
    QUERIES,
    f"WITH {DAYS} SELECT symbol, bar_ts, {OHLC} FROM days WHERE bar_ts = TIMESTAMP '1998-07-01 00:00:00'",
)
def P10_point_lookup(spark, sf):
    at = F.lit("1998-07-01 00:00:00").cast("timestamp_ntz")
    return day(spark, sf).where(F.col("bar_ts") == at).select("symbol", "bar_ts", "open", "high", "low", "close")


@register(QUERIES, f"WITH {BARS} SELECT symbol, bar_ts, {MARKET} AS market_open FROM bars")
def P11_market_open(spark, sf):
    return minute(spark, sf).select("symbol", "bar_ts", times.market_open(F.col("bar_ts")).alias("market_open"))


@register(QUERIES, f"WITH {BARS} SELECT symbol, bar_ts, close FROM bars WHERE {MARKET}")
def P12_market_rows(spark, sf):
    b = minute(spark, sf).withColumn("market_open", times.market_open(F.col("bar_ts")))
    return b.where("market_open").select("symbol", "bar_ts", "close")


@register(
    QUERIES,
    f"""WITH {BARS} SELECT symbol, bar_ts, round(coalesce(vwap, close), 6) AS price,
    round(coalesce(vwap, 0), 6) AS vwap,
    CASE WHEN close > open THEN close - open ELSE 0 END AS gain,
    CASE WHEN close > open THEN 'up' WHEN close < open THEN 'down' ELSE 'flat' END AS body,
    'minute' AS grain FROM bars""",
)
def P13_P14_P15_P21_conditional_values(spark, sf):
    b = minute(spark, sf)
    up = F.col("close") > F.col("open")
    out = b.select(
        "symbol",
        "bar_ts",
        F.coalesce("vwap", "close").alias("price"),
        "vwap",
        F.when(up, F.col("close") - F.col("open")).otherwise(0.0).alias("gain"),
        F.when(up, "up").when(F.col("close") < F.col("open"), "down").otherwise("flat").alias("body"),
        F.lit("minute").alias("grain"),
    )
    return rounded(out.fillna(0.0, ["vwap"]), 6, ["price", "vwap"])


@register(
    QUERIES,
    "SELECT CAST(strftime(CAST(ts AS DATE), '%Y-%m-%d') AS VARCHAR) AS date, event_type AS symbol FROM events GROUP BY 1, 2",
)
def A7_U5_distinct_days(spark, sf):
    e = table(spark, sf, "events")
    return e.select(F.to_date("ts").cast("string").alias("date"), F.col("event_type").alias("symbol")).distinct()


@register(QUERIES, "SELECT count(*) AS rows_total, 6 AS columns_total FROM events")
def A8_shape(spark, sf):
    e = table(spark, sf, "events")
    return e.agg(F.count(F.lit(1)).alias("rows_total")).withColumn("columns_total", F.lit(len(e.columns)))


@register(
    QUERIES,
    f"""WITH {BARS} SELECT symbol, sum(trade_count) AS trades FROM bars
    WHERE CAST(bar_ts AS DATE) BETWEEN DATE '2024-01-19' AND DATE '2024-01-19' GROUP BY 1""",
)
def A10_one_day_total(spark, sf):
    one_day = times.in_date_slice(F.col("bar_ts"), "2024-01-19", "2024-01-19")
    return minute(spark, sf).where(one_day).groupBy("symbol").agg(F.sum("trade_count").alias("trades"))


@register(QUERIES, "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def T3_tail_rows(spark, sf):
    return (
        table(spark, sf, "orders")
        .orderBy(F.desc("o_totalprice"), "o_orderkey")
        .limit(20)
        .select("o_orderkey", "o_totalprice")
    )


@register(QUERIES, f"WITH {DAYS} SELECT symbol, bar_ts, close FROM days ORDER BY symbol, bar_ts")
def T1_T2_sorted_series(spark, sf):
    return day(spark, sf).select("symbol", "bar_ts", "close").orderBy("symbol", "bar_ts")


@register(
    QUERIES,
    "SELECT name, CAST(regexp_extract(name, '[0-9]+') AS INTEGER) AS number FROM "
    "(SELECT 'close_ema_' || p_size || 'm' AS name FROM (SELECT DISTINCT l_linenumber * 5 AS p_size FROM lineitem)) "
    "ORDER BY number",
)
def T6_order_by_number_in_name(spark, sf):
    sizes = table(spark, sf, "lineitem").select((F.col("l_linenumber") * 5).alias("n")).distinct()
    named = sizes.select(F.concat(F.lit("close_ema_"), "n", F.lit("m")).alias("name"))
    return named.withColumn("number", times.leading_int(F.col("name"))).orderBy("number")


@register(
    QUERIES,
    "SELECT 'bars_v' || n_nationkey AS name, n_nationkey AS version FROM nation ORDER BY n_nationkey DESC LIMIT 1",
)
def T7_newest_version(spark, sf):
    listing = table(spark, sf, "nation").select(F.concat(F.lit("bars_v"), "n_nationkey").alias("name"))
    return catalog.newest(listing, "bars_v")


@register(
    QUERIES,
    """SELECT event_id, ts, value, 'old' AS origin FROM events WHERE ts < TIMESTAMP '2024-01-20'
    UNION ALL SELECT event_id, ts, round(value * 1.5, 6), 'new' FROM events WHERE ts >= TIMESTAMP '2024-01-20'""",
)
def U1_U2_refresh_window(spark, sf):
    old = table(spark, sf, "events").select("event_id", "ts", "value", F.lit("old").alias("origin"))
    new = old.where(times.in_date_slice(F.col("ts"), first="2024-01-20")).withColumns(
        {"value": rnd(F.col("value") * 1.5, 6), "origin": F.lit("new")}
    )
    return storage.refresh_window(old, new, "2024-01-20", ts="ts")


@register(
    QUERIES,
    """SELECT event_type AS symbol, event_id, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value,
    CASE WHEN event_type = 'click' THEN NULL ELSE user_id END AS user_id FROM events""",
)
def U3_union_of_series(spark, sf):
    """All five series; clicks come without the user, errors without the value."""
    e = table(spark, sf, "events").withColumnRenamed("event_type", "symbol").select("symbol", "event_id", "value", "user_id")
    missing = {"click": "user_id", "error": "value"}
    series = [e.where(F.col("symbol") == name).drop(missing.get(name, "")) for name in ("view", "signup", "purchase", "click", "error")]
    return functools.reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), series)


@register(
    QUERIES,
    "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)",
)
def J6_U4_set_difference(spark, sf):
    have = table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, sf, "customer").select("c_custkey").join(have, "c_custkey", "left_anti")


@register(
    QUERIES,
    """SELECT l_orderkey, l_linenumber, l_partkey,
    CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 WHEN 'R' THEN 2 END AS code FROM lineitem""",
)
def J7_mapped_codes(spark, sf):
    codes = F.create_map(*[F.lit(x) for x in ("A", 0, "N", 1, "R", 2)])
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", codes[F.col("l_returnflag")].alias("code")
    )


@register(
    QUERIES,
    """SELECT path, 'stock_bars_' || n || 'min_base_avg' AS name, 'parquet' AS extension,
      'avg' AS features_type, 'base' AS base_or_diff, n AS duration, 'min' AS duration_unit,
      n || 'min' AS time_period
    FROM (SELECT DISTINCT l_linenumber AS n,
      'data/feature_prep/stock_bars_' || l_linenumber || 'min_base_avg.parquet' AS path FROM lineitem)
    UNION ALL
    SELECT path, 'stock_bars_' || n || 'D', 'parquet', NULL, NULL, n, 'D', n || 'D'
    FROM (SELECT DISTINCT l_linenumber AS n,
      'data/data_prep/stock_bars_' || l_linenumber || 'D.parquet' AS path FROM lineitem)""",
)
def H1_H2_H3_H4_name_grammar(spark, sf):
    n = table(spark, sf, "lineitem").select(F.col("l_linenumber").alias("n")).distinct()
    long_name = F.concat(F.lit("data/feature_prep/stock_bars_"), "n", F.lit("min_base_avg.parquet"))
    short_name = F.concat(F.lit("data/data_prep/stock_bars_"), "n", F.lit("D.parquet"))
    paths = n.select(F.explode(F.array(long_name, short_name)).alias("path"))
    name = names.dataset_name(F.col("path"))
    return paths.where(F.endswith("path", F.lit(".parquet"))).select(
        "path",
        name.alias("name"),
        names.file_extension(F.col("path")).alias("extension"),
        *[c.alias(k) for k, c in names.name_parts(name).items()],
        names.time_period(name).alias("time_period"),
    )


@register(
    QUERIES,
    """SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) - 21 AS VARCHAR) AS window_start,
      CAST(CAST(o_orderdate AS DATE) + 1 AS VARCHAR) AS next_day,
      CAST(CAST(o_orderdate AS DATE) + 9 AS VARCHAR) AS ten_days,
      CAST(CAST(o_orderdate AS DATE) - 1 AS VARCHAR) AS prev_day,
      strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS text,
      CAST(strftime(o_orderdate, '%Y-%m-%d') AS TIMESTAMP) AS parsed
    FROM orders""",
)
def H5_H6_H11_day_arithmetic(spark, sf):
    d = F.to_date("o_orderdate")
    text = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        times.weeks_before(d, F.lit("3week")).cast("string").alias("window_start"),
        F.date_add(d, 1).cast("string").alias("next_day"),
        F.date_add(d, 9).cast("string").alias("ten_days"),
        F.date_sub(d, 1).cast("string").alias("prev_day"),
        text.alias("text"),
        F.to_timestamp_ntz(text, F.lit("yyyy-MM-dd HH:mm:ss")).alias("parsed"),
    )


@register(
    QUERIES,
    "SELECT event_id, ts, CAST(ts AT TIME ZONE 'UTC' AT TIME ZONE 'America/New_York' AS TIMESTAMP) AS eastern FROM events",
)
def H7_eastern_time(spark, sf):
    return table(spark, sf, "events").select("event_id", "ts", times.to_eastern(F.col("ts")).alias("eastern"))


@register(
    QUERIES,
    """SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS date, CAST(hour(ts) AS INTEGER) AS hour,
    CAST(minute(ts) AS INTEGER) AS minute, CAST(dayofyear(ts) AS INTEGER) AS day_of_year,
    hour(ts) * 60 + minute(ts) BETWEEN 570 AND 959 AS in_session FROM events""",
)
def H9_H10_date_parts(spark, sf):
    return table(spark, sf, "events").select(
        "event_id",
        F.to_date("ts").cast("string").alias("date"),
        F.hour("ts").alias("hour"),
        F.minute("ts").alias("minute"),
        F.dayofyear("ts").alias("day_of_year"),
        times.market_open(F.col("ts")).alias("in_session"),
    )


@register(
    QUERIES,
    """WITH span AS (SELECT min(o_orderdate) AS lo, max(o_orderdate) AS hi FROM orders)
    SELECT strftime(d, '%Y-%m-%d') AS date, isodow(d) < 6 AS business_day
    FROM (SELECT unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS d FROM span)""",
)
def H12_H13_date_series(spark, sf):
    span = table(spark, sf, "orders").agg(
        F.to_date(F.min("o_orderdate")).alias("lo"), F.to_date(F.max("o_orderdate")).alias("hi")
    )
    days = span.select(F.explode(F.sequence("lo", "hi")).alias("d"))
    return days.select(
        F.date_format("d", "yyyy-MM-dd").alias("date"), times.is_business_day(F.col("d")).alias("business_day")
    )


@register(
    QUERIES,
    """SELECT d AS date FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders) WHERE isodow(d) < 6
    ORDER BY md5('7:' || CAST(d AS VARCHAR)), d LIMIT 1""",
)
def H13_random_business_day(spark, sf):
    """One business day of the order dates, the same one for the same seed."""
    days = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("date")).distinct()
    return times.random_day(days.where(times.is_business_day(F.col("date"))), 7)


@register(
    QUERIES,
    f"""WITH {DAYS} SELECT symbol, bar_ts, round((high - close) / close, 8) AS upside,
    round(-(close - low) / close, 8) AS downside, CAST(close > open AS INTEGER) * trade_count AS up_trades
    FROM days""",
)
def H14_H15_arithmetic(spark, sf):
    close = F.col("close")
    return day(spark, sf).select(
        "symbol",
        "bar_ts",
        rnd(F.try_divide(F.col("high") - close, close), 8).alias("upside"),
        rnd(F.try_divide(-(close - F.col("low")), close), 8).alias("downside"),
        ((close > F.col("open")).cast("int") * F.col("trade_count")).alias("up_trades"),
    )


@register(
    QUERIES,
    """SELECT l_orderkey, l_linenumber, l_partkey,
    CASE WHEN l_discount >= l_tax AND l_discount >= 0.05 THEN 0 WHEN l_tax >= 0.05 THEN 1 ELSE 2 END AS best
    FROM lineitem""",
)
def H17_argmax(spark, sf):
    scores = table(spark, sf, "lineitem").withColumn("floor", F.lit(0.05))
    return scores.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        evaluate.argmax(["l_discount", "l_tax", "floor"]).alias("best"),
    )


@register(
    QUERIES,
    """SELECT event_id, event_type AS first_column, 2 AS columns_total FROM events""",
)
def H18_list_text(spark, sf):
    text = F.concat(F.lit("['"), F.col("event_type"), F.lit("', 'close']"))
    cols = catalog.parse_columns(text)
    return table(spark, sf, "events").select(
        "event_id", cols[0].alias("first_column"), F.size(cols).alias("columns_total")
    )


@register(
    QUERIES,
    f"""WITH {DAYS} SELECT symbol, bar_ts, 'open' AS field, open AS value FROM days
    UNION ALL SELECT symbol, bar_ts, 'high', high FROM days UNION ALL SELECT symbol, bar_ts, 'low', low FROM days
    UNION ALL SELECT symbol, bar_ts, 'close', close FROM days""",
)
def H19_long_form(spark, sf):
    return day(spark, sf).unpivot(["symbol", "bar_ts"], ["open", "high", "low", "close"], "field", "value")
