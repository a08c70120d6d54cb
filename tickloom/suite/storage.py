"""Sinks, snapshots, catalog and refresh: each query writes derived data and reads it back."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from tickloom.operators import prep
from tickloom.sources import catalog, storage
from tickloom.suite.common import BARS, DAYS, FILLED, day, filled, minute, register, table, rnd

QUERIES: dict = {}


@register(
    QUERIES,
    """SELECT l_orderkey, l_linenumber, l_partkey, l_discount AS "A", l_tax AS "B", round(1 - l_discount - l_tax, 4) AS "C" FROM lineitem""",
)
def S2_S4_csv_round_trip(spark, sf):
    scores = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.col("l_discount").alias("0"), F.col("l_tax").alias("1"),
        rnd(1 - F.col("l_discount") - F.col("l_tax"), 4).alias("2"),
    )
    path = storage.write_csv(scores, storage.new_folder(spark, "scores") + ".csv")
    back = storage.read_table(spark, path, schema=scores.schema)
    return back.withColumnsRenamed({"0": "A", "1": "B", "2": "C"})


@register(
    QUERIES,
    f"WITH {DAYS} SELECT symbol, bar_ts, close * 2 AS close FROM days WHERE bar_ts >= TIMESTAMP '1996-01-01'",
)
def S3_S15_versioned_rewrite(spark, sf):
    """The second version is computed from the first one."""
    root = storage.new_folder(spark, "bars")
    storage.write_version(day(spark, sf).select("symbol", "bar_ts", "close"), root)
    old = storage.read_version(spark, root)
    storage.write_version(storage.trim(old.withColumn("close", F.col("close") * 2), "1996-01-01"), root)
    return storage.read_version(spark, root)


@register(QUERIES, f"WITH {DAYS} SELECT symbol, bar_ts, open, high, low, close FROM days")
def S5_snapshot(spark, sf):
    root = storage.new_folder(spark, "bars")
    day(spark, sf).select("symbol", "bar_ts", "open", "high", "low", "close").write.parquet(root)
    return storage.snapshot(spark, root, f"{root}_backup")


@register(
    QUERIES,
    f"WITH {BARS} SELECT symbol, bar_ts, close FROM bars WHERE CAST(bar_ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-12'",
)
def S6_partitioned_bars(spark, sf):
    path = storage.write_partitioned(
        minute(spark, sf).select("symbol", "bar_ts", "close"), storage.new_folder(spark, "bars")
    )
    return storage.read_partitioned(spark, path, "2024-01-10", "2024-01-12").select("symbol", "bar_ts", "close")


def _store(spark, sf) -> str:
    """A small feature store: three daily bar lengths, each in a folder of its own."""
    root = storage.new_folder(spark, "store")
    daily = day(spark, sf)
    for n in (2, 5, 10):
        prep.resample_days(daily, n).write.parquet(f"{root}/stock_bars_{n}D_base_avg.parquet")
    daily.write.parquet(f"{root}/stock_bars_1D.parquet")
    return root


@register(
    QUERIES,
    "SELECT 'stock_bars_' || n || 'D_base_avg' AS name FROM (SELECT unnest([2, 5, 10]) AS n)",
)
def S7_folder_listing(spark, sf):
    files = storage.list_files(spark, _store(spark, sf), "*.parquet", contains="_avg.parquet")
    folder = F.regexp_extract("path", r"([^/]+)\.parquet/", 1)
    return files.select(folder.alias("name")).distinct()


@register(
    QUERIES,
    """SELECT * FROM (VALUES (0, 'event_id', 'bigint'), (1, 'ts', 'timestamp_ntz'), (2, 'user_id', 'bigint'),
    (3, 'event_type', 'string'), (4, 'value', 'double'), (5, 'props', 'string')) t(position, "column", type)""",
)
def S8_schema(spark, sf):
    return storage.schema_table(spark, f"{sf}/events.parquet")


@register(
    QUERIES,
    f"""WITH {FILLED}, org AS (SELECT symbol, CAST(CAST(min(bar_ts) AS DATE) AS TIMESTAMP) AS o FROM filled GROUP BY 1),
    r AS (SELECT f.symbol, w || 'min' AS duration, time_bucket(to_minutes(w), f.bar_ts, org.o) AS bar_ts,
      arg_max(close, f.bar_ts) AS close, min(f.bar_ts) AS edge
      FROM filled f JOIN org ON org.symbol = f.symbol, (SELECT unnest([5, 25, 30]) AS w) GROUP BY 1, 2, 3)
    SELECT symbol, duration, bar_ts, close FROM r WHERE edge = bar_ts""",
)
def S11_duration_folders(spark, sf):
    bars = prep.resample_many(filled(spark, sf).drop("vwap"), [5, 25, 30])
    path = storage.write_durations(bars, storage.new_folder(spark, "durations"))
    return spark.read.parquet(path).select("symbol", "duration", "bar_ts", "close")


@register(
    QUERIES,
    """SELECT * FROM (VALUES ('feature_store', '10D', 'stock_bars_10D_base_avg', 7), ('feature_store', '1D', 'stock_bars_1D', 8),
    ('feature_store', '2D', 'stock_bars_2D_base_avg', 7), ('feature_store', '5D', 'stock_bars_5D_base_avg', 7))
    t(store, time_period, name, columns_total)""",
)
def S13_catalog_from_folder(spark, sf):
    listed = catalog.from_folder(spark, _store(spark, sf))
    return listed.select("store", "time_period", "name", F.size("cols").alias("columns_total"))


@register(
    QUERIES,
    """SELECT 'feature_store' AS store, CAST((l_linenumber + 1) // 2 AS VARCHAR) || 'min' AS time_period, 'bars_' || l_partkey AS name,
      CASE WHEN bool_or(l_linenumber % 2 = 0) THEN 'new' ELSE 'old' END AS path FROM lineitem GROUP BY 1, 2, 3""",
)
def S12_catalog_upsert(spark, sf):
    """Old rows from all odd lines; those from all even lines replace them or are added."""
    items = table(spark, sf, "lineitem").select(
        F.lit("feature_store").alias("store"),
        F.concat(F.floor((F.col("l_linenumber") + 1) / 2).cast("string"), F.lit("min")).alias("time_period"),
        F.concat(F.lit("bars_"), "l_partkey").alias("name"),
        F.when(F.col("l_linenumber") % 2 == 0, "new").otherwise("old").alias("path"),
    ).distinct()
    return catalog.upsert(items.where("path = 'old'"), items.where("path = 'new'"))


@register(
    QUERIES,
    """SELECT 'feature_store' AS store, l_linenumber || 'min' AS time_period, 'bars_' || l_partkey AS name, max(l_orderkey) AS newest
    FROM lineitem GROUP BY 1, 2, 3""",
)
def S3_S12_concurrent_upserts(spark, sf):
    """Four writers put the rows of their lines into one table at the same time; none is lost."""
    root = storage.new_folder(spark, "shared-catalog")
    items = table(spark, sf, "lineitem").groupBy("l_linenumber", "l_partkey").agg(F.max("l_orderkey").alias("newest")).select(
        F.lit("feature_store").alias("store"),
        F.concat(F.col("l_linenumber").cast("string"), F.lit("min")).alias("time_period"),
        F.concat(F.lit("bars_"), "l_partkey").alias("name"),
        "newest", (F.col("l_linenumber") % 4).alias("writer"),
    )
    items = storage.stage(items, "items")

    def write(k):
        own = items.where(F.col("writer") == k).drop("writer")
        return storage.update_version(spark, root, lambda old: own if old is None else catalog.upsert(old, own))

    with ThreadPoolExecutor(4) as writers:
        numbers = sorted(writers.map(write, range(4)))
    if numbers != [1, 2, 3, 4]:
        raise ValueError(f"versions {numbers}")
    storage.remove_old_versions(spark, root, keep=1, grace_seconds=0)
    return storage.read_version(spark, root)


@register(QUERIES, "SELECT '2D' AS time_period, 'stock_bars_2D_base_avg' AS name, 'close' AS last_price")
def S14_catalog_lookup(spark, sf):
    listed = catalog.from_folder(spark, _store(spark, sf))
    found = catalog.lookup(listed, "stock_bars_2D_base_avg", "2D")
    price = F.element_at(F.filter("cols", lambda c: c.isin("open", "close")), -1)
    return found.select("time_period", "name", price.alias("last_price"))


# Symbols that a folder name would escape, read as a number, or lose.
_ODD = {"click": "BTC/USD", "view": "0700", "error": None}


@register(
    QUERIES,
    f"""WITH {BARS}, odd AS (SELECT CASE symbol WHEN 'click' THEN 'BTC/USD' WHEN 'view' THEN '0700' WHEN 'error' THEN NULL ELSE symbol END AS symbol,
      bar_ts, close FROM bars)
    SELECT symbol, bar_ts, CASE WHEN bar_ts >= TIMESTAMP '2024-01-20' THEN round(close + 1, 6) ELSE close END AS close
    FROM odd WHERE symbol IS DISTINCT FROM 'BTC/USD' OR bar_ts < TIMESTAMP '2024-01-25'""",
)
def U2_partition_refresh(spark, sf):
    """Rewrites only the dates of the window, twice; one series ends inside the window, symbols are odd."""
    bars = minute(spark, sf).select("symbol", "bar_ts", "close")
    name = F.col("symbol")
    for symbol, odd in _ODD.items():
        name = F.when(F.col("symbol") == symbol, F.lit(odd).cast("string")).otherwise(name)
    bars = bars.withColumn("symbol", name)
    path = storage.write_partitioned(bars, storage.new_folder(spark, "bars"))
    late = storage.trim(bars, "2024-01-20").withColumn("close", rnd(F.col("close") + 1, 6))
    ended = F.col("symbol").eqNullSafe("BTC/USD") & (F.col("bar_ts") >= F.lit("2024-01-25").cast("timestamp_ntz"))
    new = late.where(~ended)
    storage.refresh_partitions(spark, path, new, "2024-01-20")
    storage.refresh_partitions(spark, path, new, "2024-01-20")
    return storage.read_partitioned(spark, path).select("symbol", "bar_ts", "close")
