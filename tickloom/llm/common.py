"""Small helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.sources.storage import new_folder, shared_folder

#: White space that separates words, as a regular expression for the JVM and for DuckDB.
SPACES = r"[\x20\x09-\x0D]+"
#: One word.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once per row, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows of ``df`` from a table written to the shared folder, so that lineage ends there."""
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """Cuts the lineage with a reliable checkpoint in the shared folder."""
    shared_folder(df.sparkSession)  # gives sessions without a folder one of their own
    return df.checkpoint(eager=True)


#: Rows of a few numbers that may be broadcast.
SMALL = 200_000


def by_size(table: DataFrame) -> DataFrame:
    """A stored table for the smaller side of a join: broadcast if it has SMALL rows at most, else joined as Spark sees fit."""
    return F.broadcast(table) if table.limit(SMALL + 1).count() <= SMALL else table


def text_bytes(df: DataFrame, column: str = "text") -> int:
    """UTF-8 bytes of a text column, to size partitions by."""
    return df.agg(F.sum(F.octet_length(column))).first()[0] or 0


def pieces(total: int, each: int, least: int = 8) -> int:
    """How many pieces of about ``each`` a total makes."""
    return max(least, -(-total // each))


#: Bits of a map of hashes; its size is fixed, so it may go to every task.
MAP_BITS = 1 << 23


def hash_map(hashes: DataFrame, column: str):
    """Broadcast bitmap with the bit ``hash mod MAP_BITS`` of each value set: 1 MB, whatever the number of values.

    A reader may leave out rows whose bit is not set; those whose bit is set need an exact look.
    """
    place = F.pmod(F.col(column), F.lit(MAP_BITS)).alias("place")
    maps = hashes.select(place).groupBy(F.floor(F.col("place") / 32768).alias("part")).agg(
        F.bitmap_construct_agg(F.pmod("place", F.lit(32768))).alias("bits")
    )
    out = np.zeros((MAP_BITS // 32768, 4096), np.uint8)
    for row in maps.collect():  # at most 256 rows of 4 kB
        out[row["part"]] = np.frombuffer(bytes(row["bits"]), np.uint8)
    return hashes.sparkSession.sparkContext.broadcast(out.ravel())


def in_map(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = (hashes.view(np.uint64) & np.uint64(MAP_BITS - 1)).astype(np.int64)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
