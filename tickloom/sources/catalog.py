"""Feature catalog: one row per stored table, ``(store, time_period, name, path, cols)``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions import names
from tickloom.sources import storage

KEYS = ["store", "time_period", "name"]
SCHEMA = "store string, time_period string, name string, path string, cols array<string>"


def entry(df: DataFrame, path: str, store: str = "feature_store", time_period: str | None = None) -> DataFrame:
    """Catalog row of one table."""
    row = df.sparkSession.createDataFrame([(store, path, df.columns)], "store string, path string, cols array<string>")
    name = names.dataset_name(F.col("path"))
    period = F.lit(time_period) if time_period else names.time_period(name)
    return row.select("store", period.alias("time_period"), name.alias("name"), "path", "cols")


def entries(spark: SparkSession, tables: list[tuple[str, str, list[str]]]) -> DataFrame:
    """Catalog rows of several tables (store, path, columns), the period read from the name."""
    rows = spark.createDataFrame(tables, "store string, path string, cols array<string>")
    name = names.dataset_name(F.col("path"))
    return rows.select("store", names.time_period(name).alias("time_period"), name.alias("name"), "path", "cols")


def upsert(old: DataFrame, new: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """New rows replace old rows with the same keys; the rest stays."""
    return old.join(new, keys, "left_anti").unionByName(new)


def lookup(catalog: DataFrame, name: str, time_period: str = "1min", store: str = "feature_store") -> DataFrame:
    return catalog.where(
        (F.col("store") == store) & (F.col("time_period") == time_period) & (F.col("name") == name)
    )


def from_folder(spark: SparkSession, root: str, store: str = "feature_store") -> DataFrame:
    """Catalog of the ``*.parquet`` tables below a folder.

    Files are listed by Spark; column names come from one footer per table.
    """
    files = storage.list_files(spark, root, "*.parquet")
    table = F.regexp_extract("path", r"^(.*?\.parquet)(/.*)?$", 1)
    paths = [r["path"] for r in files.select(table.alias("path")).distinct().collect()]
    rows = [(store, p, spark.read.parquet(p).columns) for p in sorted(paths)]
    listed = spark.createDataFrame(rows, "store string, path string, cols array<string>")
    name = names.dataset_name(F.col("path"))
    return listed.select("store", names.time_period(name).alias("time_period"), name.alias("name"), "path", "cols")


def by_period(catalog: DataFrame) -> DataFrame:
    """Tables of each store and time period as one array."""
    return catalog.groupBy("store", "time_period").agg(
        F.sort_array(F.collect_list(F.struct("name", "path", "cols"))).alias("tables")
    )


def parse_columns(text: Column) -> Column:
    """List text such as "['open', 'close']" -> array of strings, without evaluating it."""
    return F.from_json(text, "array<string>", {"allowSingleQuotes": "true"})


def newest(listing: DataFrame, prefix: str, column: str = "name") -> DataFrame:
    """The row named ``{prefix}{N}`` with the largest N."""
    number = F.regexp_extract(column, f"^{prefix}(\\d+)$", 1)
    found = listing.where(number != "").withColumn("version", number.cast("int"))
    return found.orderBy(F.desc("version")).limit(1)
