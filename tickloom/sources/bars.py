"""Bar sources: landed bar files, and bars aggregated from event and order tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions import times

KEYS = ["symbol", "bar_ts"]

# Fixed value: columns of a landed bar file.
RAW_BAR_SCHEMA = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("open", T.DoubleType()),
        T.StructField("high", T.DoubleType()),
        T.StructField("low", T.DoubleType()),
        T.StructField("close", T.DoubleType()),
        T.StructField("volume", T.DoubleType()),
        T.StructField("trade_count", T.DoubleType()),
        T.StructField("vwap", T.DoubleType()),
    ]
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def read_bars(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Landed bar files in Parquet, CSV or JSON under an explicit schema (no inference pass)."""
    reader = spark.read.schema(RAW_BAR_SCHEMA)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.format(fmt).load(path)


def _aggregate(rows: DataFrame, bar: Column, order: Column) -> DataFrame:
    """Ticks ``(symbol, price, size)`` -> bars. All aggregates combine map-side."""
    return rows.groupBy("symbol", bar.alias("_bar")).agg(
        F.min_by("price", order).alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", order).alias("close"),
        F.sum("size").cast("double").alias("volume"),
        F.count(F.lit(1)).cast("double").alias("trade_count"),
        F.try_divide(F.sum(F.col("price") * F.col("size")), F.sum("size")).alias("vwap"),
    )


def _event_bars(events: DataFrame, width: int) -> DataFrame:
    ticks = events.select(
        F.col("event_type").alias("symbol"),
        "ts",
        "event_id",
        F.col("value").alias("price"),
        F.get_json_object("props", "$.k").cast("bigint").alias("size"),
    )
    bar = times.bin_start_minute(times.epoch_minute(F.col("ts")), width, F.lit(0))
    bars = _aggregate(ticks, bar, F.struct("ts", "event_id"))
    return bars.select("symbol", times.from_epoch_minute(F.col("_bar")).alias("bar_ts"), *BAR_FIELDS)


BAR_FIELDS = ["open", "high", "low", "close", "volume", "trade_count", "vwap"]


def minute_bars(events: DataFrame) -> DataFrame:
    """One bar per event type and minute."""
    return _event_bars(events, 1)


def hour_bars(events: DataFrame) -> DataFrame:
    """One bar per event type and clock hour."""
    return _event_bars(events, 60)


def day_bars(orders: DataFrame) -> DataFrame:
    """One bar per order priority and order date."""
    price = F.col("o_totalprice")
    bars = orders.groupBy(
        F.col("o_orderpriority").alias("symbol"), F.col("o_orderdate").alias("bar_ts")
    ).agg(
        F.min_by(price, "o_orderkey").alias("open"),
        F.max(price).alias("high"),
        F.min(price).alias("low"),
        F.max_by(price, "o_orderkey").alias("close"),
        F.sum(price).alias("volume"),
        F.count(F.lit(1)).cast("double").alias("trade_count"),
    )
    return bars
