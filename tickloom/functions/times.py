"""Time arithmetic on naive (TIMESTAMP_NTZ) columns.

Everything goes through calendar parts of the naive timestamp, so no result depends on the
session time zone or on daylight-saving shifts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MINUTES_PER_DAY = 1440

# Regular trading session, local time, [09:30, 16:00).
SESSION_OPEN_MINUTE = 9 * 60 + 30
SESSION_CLOSE_MINUTE = 16 * 60


def to_eastern(ts: Column, source_zone: str = "UTC") -> Column:
    """Wall-clock time in ``source_zone`` -> naive US/Eastern wall-clock time."""
    return F.convert_timezone(
        F.lit(source_zone), F.lit("America/New_York"), ts.cast("timestamp_ntz")
    )


def instant_to_eastern(ts: Column) -> Column:
    """TIMESTAMP (an instant) -> naive US/Eastern wall-clock time, whatever the session zone."""
    return F.convert_timezone(
        F.current_timezone(), F.lit("America/New_York"), ts.cast("timestamp_ntz")
    )


def minute_of_day(ts: Column) -> Column:
    return F.hour(ts) * 60 + F.minute(ts)


def epoch_day(ts: Column) -> Column:
    return F.unix_date(F.to_date(ts))


def epoch_minute(ts: Column) -> Column:
    """Whole minutes since 1970-01-01 00:00 of the naive timestamp (INT)."""
    return epoch_day(ts) * MINUTES_PER_DAY + minute_of_day(ts)


def from_epoch_minute(minute: Column) -> Column:
    """Inverse of :func:`epoch_minute`."""
    return F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.lit(0), minute.cast("int"), F.lit(0)
    )


def floor_minute(ts: Column) -> Column:
    return from_epoch_minute(epoch_minute(ts))


def bin_start_minute(minute: Column, width: int, origin_minute: Column) -> Column:
    """Start (epoch minute) of the ``width``-minute bin holding ``minute``, counted from an origin."""
    return (
        origin_minute + F.floor((minute - origin_minute) / F.lit(width)).cast("int") * width
    )


def market_open(ts: Column) -> Column:
    """True from 09:30 up to, not including, 16:00 local time."""
    m = minute_of_day(ts)
    return (m >= SESSION_OPEN_MINUTE) & (m < SESSION_CLOSE_MINUTE)


def in_date_slice(ts: Column, first: str | None = None, last: str | None = None) -> Column:
    """Whole-day inclusive slice, written on the raw column so that it reaches the file scan."""
    cond = F.lit(True)
    if first is not None:
        cond = cond & (ts >= F.lit(first).cast("timestamp_ntz"))
    if last is not None:
        cond = cond & (ts < F.date_add(F.lit(last).cast("date"), 1).cast("timestamp_ntz"))
    return cond


def seconds_between(later: Column, earlier: Column) -> Column:
    """Seconds from ``earlier`` to ``later`` as DOUBLE, microseconds kept."""

    def micros(ts: Column) -> Column:
        second = F.date_part(F.lit("SECOND"), ts).cast("double")
        return epoch_minute(ts).cast("double") * 60 + second

    return micros(later) - micros(earlier)


def days_between(spark: SparkSession, first: str, last: str, business_only: bool = False) -> DataFrame:
    """One row per calendar day (or Monday-Friday day) in the inclusive range."""
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias("date")
    )
    return days.where(is_business_day(F.col("date"))) if business_only else days


def is_business_day(day: Column) -> Column:
    return F.weekday(day) < 5


def random_day(days: DataFrame, seed: int) -> DataFrame:
    """One day picked at random: the one whose hash with the seed is least, however the days are spread."""
    return days.orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.col("date").cast("string"))), "date").limit(1)


def weeks_before(day: Column, window: Column) -> Column:
    """Start of a refresh window such as '3week' that ends on ``day``."""
    return F.date_sub(day, leading_int(window) * 7)


def leading_int(text: Column) -> Column:
    """First run of digits in a string, as INT."""
    return F.regexp_extract(text, r"(\d+)", 1).cast("int")
