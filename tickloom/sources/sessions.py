"""Exchange calendars: a row per trading date, with holidays and half days, kept as a versioned table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions import times
from tickloom.sources import storage

#: Columns of a landed calendar; times are text such as 09:30 or 0930.
SCHEMA = "date date, open string, close string, session_open string, session_close string, settlement_date date"
#: Days after a date within which its settlement is looked for.
SETTLES_WITHIN = 14


def with_exceptions(calendar: DataFrame, exceptions: DataFrame) -> DataFrame:
    """The calendar with ``exceptions`` (date, close): a date without a close is a holiday, one with a close ends early.

    An early close ends the extended session too. A date settles on the next one of the calendar that is left (null where
    none follows within two weeks). Exceptions on dates that the calendar doesn't have, and those without a date, change nothing.
    """
    changes = exceptions.where("date IS NOT NULL").groupBy("date").agg(F.min("close").alias("_close"), F.lit(True).alias("_changed"))
    marked = calendar.join(changes, "date", "left").where("_changed IS NULL OR _close IS NOT NULL")
    early = marked.withColumns(
        {"close": F.coalesce("_close", "close"), "session_close": F.coalesce(F.regexp_replace("_close", ":", ""), "session_close")}
    ).drop("_close", "_changed", "settlement_date")
    dates = early.select(F.col("date").alias("_next")).distinct()
    ahead = early.select("date", F.explode(F.sequence(F.date_add("date", 1), F.date_add("date", SETTLES_WITHIN))).alias("_next")).distinct()
    settles = ahead.join(dates, "_next").groupBy("date").agg(F.min("_next").alias("settlement_date"))
    return early.join(settles, "date", "left").select(*calendar.columns)


def store(calendar: DataFrame, root: str) -> str:
    """A new version of the calendar; dates that are null or there twice, and sessions that end before they begin, are errors."""
    bad = minutes(calendar).groupBy("date").agg(F.count(F.lit(1)).alias("n"), F.bool_and(F.col("_opens") < F.col("_closes")).alias("ordered"))
    bad = bad.where("date IS NULL OR n > 1 OR NOT coalesce(ordered, false)").orderBy("date").limit(5).collect()
    if bad:
        raise ValueError(f"dates that are null, repeated or without a session: {[str(r['date']) for r in bad]}")
    return storage.write_version(calendar, root)


def read(spark: SparkSession, root: str) -> DataFrame:
    return storage.read_version(spark, root)


def minute_of(text: Column) -> Column:
    """Minute of the day of a time such as 09:30 or 0930; null for other text."""
    found = F.regexp_extract(text, r"^(\d{1,2}):?(\d{2})$", 1), F.regexp_extract(text, r"^(\d{1,2}):?(\d{2})$", 2)
    return F.when(found[0] != "", found[0].cast("int") * 60 + found[1].cast("int"))


def minutes(calendar: DataFrame) -> DataFrame:
    """date, and the minutes of the day at which the regular and the extended session open and close."""
    names = {"_opens": "open", "_closes": "close", "_first": "session_open", "_last": "session_close"}
    return calendar.select("date", *[minute_of(F.col(c)).alias(name) for name, c in names.items()])


def with_sessions(bars: DataFrame, calendar: DataFrame) -> DataFrame:
    """Adds ``market_open`` and ``extended_open`` from the sessions of the bar's date; false on dates without one.

    A bar at the close is outside. The calendar has a row per date, so its join is small beside any bars; a bar without a time has no session.
    """
    now = times.minute_of_day(F.col("bar_ts"))
    sessions = minutes(calendar).withColumnRenamed("date", "_date")
    inside = lambda a, b: F.coalesce((now >= F.col(a)) & (now < F.col(b)), F.lit(False))
    rows = bars.join(sessions, F.to_date("bar_ts") == F.col("_date"), "left")
    return rows.withColumns({"market_open": inside("_opens", "_closes"), "extended_open": inside("_first", "_last")}).drop("_date", "_opens", "_closes", "_first", "_last")
