"""Calendars with exceptions, and the order of rows as stored."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tickloom.operators import prep
from tickloom.plans import batch as b
from tickloom.sources import sessions, storage


def day(text):
    return dt.date.fromisoformat(text)


def exceptions(spark, *rows):
    return spark.createDataFrame([(day(d) if d else None, c) for d, c in rows], "date date, close string")


def at(spark, *times):
    return spark.createDataFrame([("a", t) for t in times], "symbol string, t string").select("symbol", F.col("t").cast("timestamp_ntz").alias("bar_ts"))


def test_holidays_half_days_and_settlement(spark):
    calendar = storage.trading_calendar(spark, "2024-07-01", "2024-07-09")
    changed = sessions.with_exceptions(calendar, exceptions(spark, ("2024-07-04", None), ("2024-07-03", "13:00"), ("2024-07-06", "12:00"), (None, None)))
    rows = {str(r["date"]): r for r in changed.collect()}
    assert sorted(rows) == ["2024-07-01", "2024-07-02", "2024-07-03", "2024-07-05", "2024-07-08", "2024-07-09"]
    assert (rows["2024-07-03"]["close"], rows["2024-07-03"]["session_close"]) == ("13:00", "1300")
    assert (rows["2024-07-05"]["close"], rows["2024-07-05"]["session_close"]) == ("16:00", "2000")
    settles = {d: str(r["settlement_date"]) for d, r in rows.items()}
    assert settles == {
        "2024-07-01": "2024-07-02", "2024-07-02": "2024-07-03", "2024-07-03": "2024-07-05", "2024-07-05": "2024-07-08", "2024-07-08": "2024-07-09", "2024-07-09": "None",
    }
    assert changed.columns == calendar.columns


def test_sessions_of_bars(spark, tmp_path):
    calendar = sessions.with_exceptions(storage.trading_calendar(spark, "2024-07-01", "2024-07-09"), exceptions(spark, ("2024-07-04", None), ("2024-07-03", "13:00")))
    root = str(tmp_path / "calendar")
    sessions.store(calendar, root)
    bars = at(
        spark, "2024-07-03 09:29", "2024-07-03 09:30", "2024-07-03 12:59", "2024-07-03 13:00", "2024-07-04 10:00", "2024-07-05 15:59", "2024-07-05 16:00",
        "2024-07-05 20:00", "2024-07-06 10:00", "2025-01-02 10:00", None,
    )
    out = sessions.with_sessions(bars, sessions.read(spark, root)).collect()
    assert len(out) == 11
    regular = sorted(str(r["bar_ts"])[5:16] for r in out if r["market_open"])
    assert regular == ["07-03 09:30", "07-03 12:59", "07-05 15:59"]
    extended = sorted(str(r["bar_ts"])[5:16] for r in out if r["extended_open"])
    assert extended == ["07-03 09:29", "07-03 09:30", "07-03 12:59", "07-05 15:59", "07-05 16:00"]
    with_batch = b.with_market_open(bars, b.Batch(root=str(tmp_path), calendar=root))
    assert with_batch.columns == ["symbol", "bar_ts", "market_open"] and with_batch.where("market_open").count() == 3
    assert b.with_market_open(bars, b.Batch(root=str(tmp_path))).where("market_open").count() == 7


@pytest.mark.parametrize("change", [lambda c: c.union(c.limit(1)), lambda c: c.withColumn("date", F.lit(None).cast("date")).limit(1), lambda c: c.withColumn("close", F.lit("08:00")), lambda c: c.withColumn("open", F.lit("soon"))])
def test_a_broken_calendar_is_refused(spark, tmp_path, change):
    with pytest.raises(ValueError, match="without a session"):
        sessions.store(change(storage.trading_calendar(spark, "2024-07-01", "2024-07-09")), str(tmp_path / "no"))
    assert storage.versions(spark, str(tmp_path / "no")) == []


def minutes(spark, rows):
    """(symbol, minute) rows as one file, in the order given."""
    made = spark.createDataFrame([(i, s, m) for i, (s, m) in enumerate(rows)], "i int, symbol string, m int").coalesce(1).sortWithinPartitions("i")
    return made.select("symbol", F.expr("timestampadd(MINUTE, m, TIMESTAMP_NTZ'2024-01-01 00:00:00')").alias("bar_ts"))


@pytest.mark.parametrize("run", [2, 3, 65_536])
def test_order_as_stored(spark, tmp_path, run):
    rows = [("a", 1), ("b", 9), ("a", 2), (None, 4), ("a", None), ("b", 3), ("a", 2), ("b", 8), ("b", 9), (None, 3), ("a", 7)]
    minutes(spark, rows).write.parquet(str(tmp_path / "bars"))
    stored = spark.read.parquet(str(tmp_path / "bars"))
    found = {r["symbol"]: r for r in prep.disordered(stored, run=run).collect()}
    assert {s: (r["rows"], r["out_of_order"], r["first_row"], r["first_ts"].minute, r["after_ts"].minute) for s, r in found.items()} == {"b": (4, 2, 5, 3, 9), None: (2, 1, 9, 3, 4)}
    with pytest.raises(ValueError, match="None is out of order at row 9"):
        prep.require_order(stored)
    good = stored.where("symbol = 'a'")
    assert prep.require_order(good) is good
    assert prep.disordered(stored.limit(0)).count() == 0
