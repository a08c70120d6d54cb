"""Incremental runs of the batch against full ones."""

import math

import pytest
from pyspark.sql import functions as F

from tickloom.operators import indicators as ind
from tickloom.operators import intraday, prep
from tickloom.plans import batch as b
from tickloom.plans import incremental as inc
from tickloom.sources import bars as sources
from tickloom.sources import storage

SF = "/root/testdata/sf0.001"


def rows_of(df):
    """Rows by key with floats cut to nine digits, as frames are added up in blocks that may begin elsewhere."""

    def cell(v):
        return float(f"{v:.9g}") if isinstance(v, float) and not math.isnan(v) else v

    columns = sorted(df.columns)
    return sorted((tuple(cell(r[c]) for c in columns) for r in df.collect()), key=str)


def near(mine, theirs):
    assert len(mine) == len(theirs) and mine
    for x, y in zip(mine, theirs):
        for a, c in zip(x, y):
            same = a == c or (isinstance(a, float) and isinstance(c, float) and math.isclose(a, c, rel_tol=1e-7, abs_tol=1e-7))
            assert same, (x[-1], a, c)


@pytest.fixture(scope="module")
def landed(spark):
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")  # a few thousand rows
    events, orders = sources.table(spark, SF, "events"), sources.table(spark, SF, "orders")
    minute = storage.stage(sources.minute_bars(events).where("symbol in ('click', 'view') and bar_ts < '2024-01-09'"))
    # Two years of days, so that the day of the year repeats, and a series that ends early.
    day = storage.stage(sources.day_bars(orders).where("bar_ts < '1996-12-01' and (symbol <> '5-LOW' or bar_ts < '1996-02-01')"))
    yield minute, day
    spark.conf.set("spark.sql.shuffle.partitions", was)


def changed(bars, start):
    """Bars from a day on with other prices, a symbol less and a new one."""
    after = storage.trim(bars, start).withColumn("close", F.col("close") + 0.25).withColumn("high", F.col("high") + 0.25)
    gone = after.where("symbol <> 'view'")
    return gone.unionByName(gone.withColumn("symbol", F.lit("fresh")))


def test_a_change_reads_and_writes_later_folders_only(spark, landed, tmp_path):
    """The whole update against SQL is the query M11_incremental_batch."""
    minute, _ = landed
    start, plan = "2024-01-07", b.Batch(root=str(tmp_path / "step"))
    averages = plan.path("feature_prep", "5min", "_base_avg")
    units = lambda: {str(r["date"]): r["unit"] for r in storage.read_version(spark, f"{averages}/dates").collect()}
    series = [inc.Update(spark, plan, at).series("feature_prep", "5min", "_base_avg") for at in ("2024-01-01", start)]
    specs, new = ind.ema_specs(["close"], [5]), changed(minute, start)
    series[0].replace(series[0].scanned(minute, specs, "states"))
    before = units()
    series[1].replace(series[1].scanned(new, specs, "states"))
    after = units()
    assert {d for d in after if before.get(d) == after[d]} == {d for d in before if d < start}
    full = ind.exponential_averages(storage.refresh_window(minute, new, start), ["close"], [5], "minute")
    near(rows_of(series[1].whole()), rows_of(full))
    assert min(f.split("date=")[1][:10] for f in series[1].rows().inputFiles()) == start
    looked_back = series[1].with_rows_before(60)
    # A sparse series needs more days; only those are read.
    days = {f.split("date=")[1][:10] for f in looked_back.inputFiles() if "date=" in f}
    assert min(days) < start and {str(r["date"]) for r in series[1].before(60).select(inc._folder_date("minute").alias("date")).collect()} == {d for d in days if d < start}
    older = lambda df: {r["symbol"]: r["count"] for r in df.where(F.col("bar_ts") < start).groupBy("symbol").count().collect()}
    found, whole = older(looked_back), older(minute)
    assert found.keys() == whole.keys() and all(found[s] >= min(60, whole[s]) for s in whole)


def test_longer_bars_after_a_change(spark, landed, tmp_path):
    """Bins of 25 minutes and 30 days are counted from the first day; empty bins of days stay."""
    minute, day = landed
    late = storage.trim(day, "1996-06-01").where("bar_ts >= '1996-08-15'")
    cases = [("minute", "1min", "25min", minute, "2024-01-01", "2024-01-07", changed(minute, "2024-01-07")), ("day", "1D", "30D", day, "1995-01-01", "1996-06-01", late)]
    for granularity, base, duration, bars, first, start, new in cases:
        plan = b.Batch(root=str(tmp_path / granularity), durations=[duration])
        for rows, at in ((bars, first), (new, start)):
            b.refresh(spark, plan, {granularity: rows}, at)
            run = inc.Update(spark, plan, at)
            run.resampled(run.source_bars(base), [duration])
        whole = storage.refresh_window(bars, new, start)
        if granularity == "day":
            wanted = prep.resample_days(whole, 30)
        else:
            wanted = prep.resample(prep.with_market_open(prep.fill_minutes(whole)).drop("vwap"), 25)
        mine = storage.read_partitioned(spark, plan.path("data_prep", duration)).drop("date")
        near(rows_of(mine), rows_of(wanted.select(*mine.columns)))


def test_frames_over_chunks_of_years(spark, landed, tmp_path):
    _, day = landed
    plan = b.Batch(root=str(tmp_path / "days"))
    start = "1996-06-01"
    series = [inc.Update(spark, plan, at).series("data_prep", "1D") for at in ("1995-01-01", start)]
    states = series[0].scanned(day, ind.ema_specs(["close"], [5]), "states")
    assert states.count() == day.count()
    series[0].replace(day)
    assert (series[1].first, series[1].start) == (1996, "1996-01-01")
    rows = series[1].with_rows_before(3)
    kept = rows.groupBy("symbol").agg(F.min(F.year("bar_ts")).alias("y")).collect()
    assert {r.y for r in kept} == {1995}  # whole chunks
    both = series[1].scanned(day.where("bar_ts >= '1996-01-01'"), ind.ema_specs(["close"], [5]), "states").select("symbol", "bar_ts", "close_ema_5m")
    whole = ind.exponential_averages(day, ["close"], [5], "day").where("bar_ts >= '1996-01-01'").select(*both.columns)
    near(rows_of(both), rows_of(whole))
    # Day extremes go on from the same day of earlier years.
    open_day = prep.with_market_open(day)
    earlier = intraday.date_extremes(open_day.where("bar_ts < '1996-01-01'"))
    later = intraday.with_day_extremes(open_day.where("bar_ts >= '1996-01-01'"), earlier=earlier)
    near(rows_of(later), rows_of(intraday.with_day_extremes(open_day).where("bar_ts >= '1996-01-01'").select(*later.columns)))


def test_missing_states_and_other_keys_are_errors(spark, landed, tmp_path):
    minute, _ = landed
    plan = b.Batch(root=str(tmp_path / "odd"), label_duration="5min", training_features=("rsi",))
    with pytest.raises(ValueError, match="label duration"):
        inc.update(spark, b.Batch(root=str(tmp_path / "none"), durations=["30D"]), {"minute": minute.limit(3)}, "2024-01-01")
    run = inc.Update(spark, plan, "2024-01-01")
    base = minute.select("symbol", "bar_ts", "close")
    for folder, suffix, rows in [("feature_prep", "_base_avg", base), ("feature_prep", "_base_rsi", base.where("symbol = 'view'")), ("dependent_variable", "_base_avg", base)]:
        run.series(folder, "5min", suffix).replace(rows)
    with pytest.raises(ValueError, match="other keys"):
        run.training_table("2024-01-01")
    with pytest.raises(ValueError, match="first day"):
        run.series("feature_prep", "5min", "_base_avg").scanned(base, ind.ema_specs(["close"], [5]), "states")
