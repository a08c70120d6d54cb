"""Reading and writing bar and feature tables on a shared file system."""

from __future__ import annotations

import os
import tempfile
import time
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions import times

_own_folder: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """Folder for intermediate tables: the cluster's ``spark.checkpoint.dir``.

    Where that is unset, as in tests, the session gets a folder of its own, which serves a single machine only.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not _own_folder:
        _own_folder.append(tempfile.mkdtemp(prefix="tickloom-"))
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(_own_folder[0])
    return _own_folder[0]


def _application_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/tickloom-{spark.sparkContext.applicationId}"


def new_folder(spark: SparkSession, label: str) -> str:
    """Unused folder below this application's part of the shared folder."""
    return f"{_application_folder(spark)}/{label}-{uuid.uuid4().hex}"


def clear_stages(spark: SparkSession) -> None:
    """Removes the intermediate tables of this application, once its results are stored."""
    fs, where = _files(spark, _application_folder(spark))
    fs.delete(where, True)


def _files(spark: SparkSession, path: str):
    """Hadoop (FileSystem, Path) of a location, so any shared store works."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _files(spark, path)
    return fs.exists(where)


# -- scans ----------------------------------------------------------------------------------


def read_table(spark: SparkSession, path: str, columns: list[str] | None = None, schema=None) -> DataFrame:
    """Parquet or CSV by extension; only the listed columns are read."""
    if path.rstrip("/").endswith(".csv"):
        reader = spark.read.option("header", True)
        df = (reader.schema(schema) if schema else reader).csv(path)
    else:
        df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def list_files(spark: SparkSession, root: str, pattern: str = "*", contains: str | None = None) -> DataFrame:
    """All files below a folder as ``(path, length)``; contents are not read."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(root)
        .select("path", "length")
    )
    return files.where(F.contains("path", F.lit(contains))) if contains else files


def schema_table(spark: SparkSession, path: str) -> DataFrame:
    """Column positions, names and types, from the file footers only."""
    fields = spark.read.parquet(path).schema.fields
    return spark.createDataFrame(
        [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(fields)],
        "position int, column string, type string",
    )


# -- sinks ----------------------------------------------------------------------------------


def write_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


class VersionConflict(RuntimeError):
    """Another writer has stored a version since the one that this write builds on."""


def _put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Creates a small file with its content in one step; False if there is one already.

    The content is complete before the file gets its name. On one machine a hard link refuses a name that is taken; on HDFS
    rename does. A store whose rename replaces files serves one writer at a time.
    """
    fs, where = _files(spark, path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(where.getParent(), f".{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    out.write(text.encode())
    out.close()
    try:
        if fs.getUri().getScheme() != "file":
            return not fs.exists(where) and fs.rename(draft, where)
        try:
            os.link(draft.toUri().getPath(), where.toUri().getPath())
            return True
        except FileExistsError:
            return False
    finally:
        fs.delete(draft, False)


def _text_of(spark: SparkSession, path: str) -> str:
    fs, where = _files(spark, path)
    source = fs.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()


def versions(spark: SparkSession, root: str) -> list[int]:
    """Stored versions of a table, oldest first."""
    fs, where = _files(spark, f"{root}/_versions")
    if not fs.exists(where):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(where)]
    return sorted(int(name) for name in names if name.isdigit())


def write_version(df: DataFrame, root: str, after: int | None = None) -> str:
    """Writes the rows to a folder of their own, then makes them the next version; returns the folder.

    A version is a small file ``_versions/N`` that names its folder and is created only where there is none, so no two writers get the
    same number and readers keep the last good version when a write fails. A table can be rewritten from its own
    rows. With ``after``, the version that the rows were made from (0 for none), a newer one is a VersionConflict; without, the rows replace whatever is newest.
    """
    spark = df.sparkSession
    folder = f"f={uuid.uuid4().hex}"
    df.write.parquet(f"{root}/{folder}")
    while True:
        newest = max(versions(spark, root), default=0)
        if after is not None and newest != after:
            raise VersionConflict(f"{root}: version {newest} was stored after version {after}")
        if _put_if_absent(spark, f"{root}/_versions/{newest + 1:020d}", folder):
            return f"{root}/{folder}"


def read_version(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The newest version, or the one asked for if it is stored."""
    done = versions(spark, root)
    chosen = version if version is not None else done[-1] if done else None
    if chosen not in done:
        raise FileNotFoundError(f"no finished version {'' if version is None else version} in {root}")
    return spark.read.parquet(f"{root}/{_text_of(spark, f'{root}/_versions/{chosen:020d}')}")


def update_version(spark: SparkSession, root: str, change: Callable[[DataFrame | None], DataFrame]) -> int:
    """Stores ``change(newest rows, or None)`` as the next version; made anew if another writer comes first. Returns the version."""
    while True:
        newest = max(versions(spark, root), default=0)
        try:
            write_version(change(read_version(spark, root, newest) if newest else None), root, newest)
            return newest + 1
        except VersionConflict:
            continue


def remove_old_versions(spark: SparkSession, root: str, keep: int = 2, grace_seconds: float = 86_400) -> None:
    """Removes all but the newest ``keep`` versions, and folders that none of these names.

    Folders changed within the grace time stay, as a writer may be about to name them or a reader may still read them; the
    time must be longer than any write or read of the table.
    """
    done = versions(spark, root)
    fs, _ = _files(spark, root)
    kept = {_text_of(spark, f"{root}/_versions/{n:020d}") for n in done[-max(1, keep):]}
    _remove_folders(spark, root, "f=", kept, grace_seconds)
    for n in done[: -max(1, keep)]:
        if not exists(spark, f"{root}/{_text_of(spark, f'{root}/_versions/{n:020d}')}"):
            fs.delete(_files(spark, f"{root}/_versions/{n:020d}")[1], False)


def _remove_folders(spark: SparkSession, root: str, prefix: str, kept: set[str], grace_seconds: float) -> None:
    fs, where = _files(spark, root)
    for status in fs.listStatus(where) if fs.exists(where) else []:
        name = status.getPath().getName()
        old = status.getModificationTime() <= (time.time() - grace_seconds) * 1000
        if name.startswith(prefix) and name not in kept and old:
            fs.delete(status.getPath(), True)


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Writes an intermediate table to the shared folder and reads it back.

    Steps that read their input more than once start from a stage, so that a chain of steps costs
    the sum of its steps; a lost executor repeats only the step at hand.
    """
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def snapshot(spark: SparkSession, path: str, backup: str) -> DataFrame:
    """Copies a table before it is overwritten; returns the copy."""
    spark.read.parquet(path).write.mode("overwrite").parquet(backup)
    return spark.read.parquet(backup)


def _period_start(ts: Column, period: str) -> Column:
    return F.trunc(F.to_date(ts), period) if period != "day" else F.to_date(ts)


def _write_dates(bars: DataFrame, root: str, period: str) -> DataFrame:
    """Writes a unit of rows by date below ``root``; returns its (date, unit) rows.

    Rows are dealt by ranges of (date, symbol, time): a file holds neighbouring rows of few dates, a
    date of many rows has several files, and row groups are narrow in symbol and time. The symbol stays a
    column, so its type and its nulls stay too.
    """
    unit = f"u{uuid.uuid4().hex}"
    path = f"{root}/data/unit={unit}"
    order = ["date", "symbol", "bar_ts"]
    rows = bars.withColumn("date", _period_start(F.col("bar_ts"), period))
    rows.repartitionByRange(*order).sortWithinPartitions(*order).write.partitionBy("date").parquet(path)
    # The folders that were written, so that the rows are evaluated once.
    written = bars.sparkSession.read.schema(rows.schema).option("basePath", path).parquet(path)
    return written.select("date").distinct().select("date", F.lit(unit).alias("unit"))


def write_partitioned(bars: DataFrame, root: str, period: str = "day") -> str:
    """A table in folders by date: the day, or the first day of the month or year for coarser bars.

    Rows are in units, each written whole; a versioned list says which unit holds a date, and a new
    version of the list is what replaces rows. Readers see the old or the new rows, never some of both.
    """
    write_version(_write_dates(bars, root, period), f"{root}/dates")
    return root


def is_partitioned(spark: SparkSession, root: str) -> bool:
    return bool(versions(spark, f"{root}/dates"))


def read_partitioned(
    spark: SparkSession, root: str, first: str | None = None, last: str | None = None, also: DataFrame | None = None, version: int | None = None
) -> DataFrame:
    """Rows of a table written by date; with dates, of the folders from ``first`` to ``last`` only.

    ``version`` of the list of dates, the newest by default; ``also`` names further folders (a column ``date``) before ``first``. What comes to the driver is a row per date.
    """
    listed = read_version(spark, f"{root}/dates", version)
    dates = listed
    if first:
        dates = dates.where(F.col("date") >= F.lit(first).cast("date"))
        if also is not None:
            older = listed.where(F.col("date") < F.lit(first).cast("date"))
            dates = dates.unionByName(older.join(also.select("date").distinct(), "date", "left_semi"))
    if last:
        dates = dates.where(F.col("date") <= F.lit(last).cast("date"))
    default = "__HIVE_DEFAULT_PARTITION__"
    folders = [f"{root}/data/unit={r['unit']}/date={r['date'] or default}" for r in dates.collect()]
    if not folders:
        unit = listed.select("unit").first()
        if unit is None:
            raise FileNotFoundError(f"no rows in {root}")
        return spark.read.option("basePath", f"{root}/data").parquet(f"{root}/data/unit={unit[0]}").drop("unit").limit(0)
    return spark.read.option("basePath", f"{root}/data").parquet(*folders).drop("unit")


def write_durations(bars: DataFrame, path: str) -> str:
    """One folder per bar length from a table with a ``duration`` column."""
    bars.write.mode("overwrite").partitionBy("duration").parquet(path)
    return path


# -- refresh --------------------------------------------------------------------------------


def refresh_window(old: DataFrame, new: DataFrame, start: str, ts: str = "bar_ts") -> DataFrame:
    """Old rows before ``start`` plus all re-fetched rows."""
    cutoff = F.lit(start).cast(dict(old.dtypes)[ts])
    return old.where(F.col(ts) < cutoff).unionByName(new)


def refresh_partitions(
    spark: SparkSession, root: str, new: DataFrame, start: str, period: str = "day"
) -> None:
    """The same on a table written by date, rewriting only the dates of the window.

    ``start`` is a date. Rows before it that share a folder with the window are kept. The window is
    written as a new unit and counts once the new list of dates is stored: a failure before leaves the
    table as it was, and running it twice with the same rows changes nothing. Of several writers at a time each
    one's list is made from the newest, so none is lost and the result is that of running them one after the other. Only where
    another writer has replaced the folder that the kept rows were read from is the window written again.
    """
    cutoff = F.lit(start).cast("timestamp_ntz")
    opens = _period_start(cutoff, period)
    dates = f"{root}/dates"

    def shared_unit(version: int) -> list:
        return read_version(spark, dates, version).where(F.col("date") == opens).collect()

    newest = versions(spark, dates)[-1]
    base, written = newest, None
    while True:
        if written is None or shared_unit(newest) != shared_unit(base):
            base = newest
            earlier = read_partitioned(spark, root, version=base).where((F.col("date") >= opens) & (F.col("bar_ts") < cutoff))
            written = _write_dates(earlier.select(*new.columns).unionByName(new), root, period)
        before = read_version(spark, dates, newest).where(F.col("date").isNull() | (F.col("date") < opens))
        try:
            write_version(before.unionByName(written), dates, newest)
            return
        except VersionConflict:
            newest = versions(spark, dates)[-1]


def remove_old_units(spark: SparkSession, root: str, keep: int = 2, grace_seconds: float = 86_400) -> None:
    """Removes old lists of dates, and units that no list kept names; the grace time is that of remove_old_versions.

    What comes to the driver is a row per unit.
    """
    dates = f"{root}/dates"
    remove_old_versions(spark, dates, keep, grace_seconds)
    units: set[str] = set()
    for n in versions(spark, dates):
        units |= {f"unit={r['unit']}" for r in read_version(spark, dates, n).select("unit").distinct().collect()}
    _remove_folders(spark, f"{root}/data", "unit=", units, grace_seconds)


def trim(df: DataFrame, first: str, ts: str = "bar_ts") -> DataFrame:
    """Rows from ``first`` on, for rewriting an archive."""
    return df.where(times.in_date_slice(F.col(ts), first=first))


def trading_calendar(spark: SparkSession, first: str, last: str) -> DataFrame:
    """One row per Monday-Friday day with regular and extended session times."""
    # Session times and settlement after one business day.
    days = times.days_between(spark, first, last, business_only=True)
    settles = F.when(F.weekday("date") == 4, F.date_add("date", 3)).otherwise(F.date_add("date", 1))
    return days.select(
        "date",
        F.lit("09:30").alias("open"),
        F.lit("16:00").alias("close"),
        F.lit("0400").alias("session_open"),
        F.lit("2000").alias("session_close"),
        settles.alias("settlement_date"),
    )
