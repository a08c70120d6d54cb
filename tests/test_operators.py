"""Hand-checked tables for edge cases, and pandas cross-checks."""

from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickloom.functions import names, times
from tickloom.operators import assemble, evaluate, intraday, labels, prep
from tickloom.operators import indicators as ind
from tickloom.sources import bars as sources
from tickloom.sources import catalog, storage

BAR = "symbol string, bar_ts timestamp_ntz, open double, high double, low double, close double, volume double"


def bars(spark, stamps, close, volume=None, symbol="s"):
    volume = volume or [1.0] * len(close)
    rows = [(symbol, datetime.fromisoformat(t), c, c, c, c, v) for t, c, v in zip(stamps, close, volume)]
    return spark.createDataFrame(rows, BAR)


def daily(spark, values, symbol="s"):
    rows = [(symbol, datetime(2024, 1, 1) + timedelta(days=i), v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "symbol string, bar_ts timestamp_ntz, close double")


def column(df, name):
    return [r[name] for r in df.orderBy("symbol", "bar_ts").select(name).collect()]


def test_simple_average_needs_a_full_frame(spark):
    out = ind.simple_averages(daily(spark, [1.0, None, 3.0, 4.0, 5.0]), ["close"], [2], "day")
    assert column(out, "close_sma_2m") == [None, None, None, 3.5, 4.5]


def test_smoothed_average_with_min_periods(spark):
    from tickloom.plans.scan import Ewm, ewm_scan

    out = column(ewm_scan(daily(spark, [0.0, 1.0, 2.0, 3.0]), [Ewm("close", 1 / 3, "e", 3)], "day"), "e")
    assert out[:2] == [None, None]
    np.testing.assert_allclose(out[2:], [0.888889, 1.592593], atol=1e-6)


def test_rsi_matches_pandas(spark):
    rng = np.random.default_rng(5)
    x = pd.Series(rng.normal(0, 1, 400).cumsum() + 50)
    d = x.diff()
    gain, loss = d.clip(lower=0).fillna(0), (-d).clip(lower=0).fillna(0)
    g, l = (v.ewm(alpha=1 / 14, min_periods=14, adjust=False).mean() for v in (gain, loss))
    out = ind.rsi(daily(spark, x.tolist()), ["close"], [14], "day")
    got = np.array(column(out, "close_14window_rsi"), dtype=float)
    np.testing.assert_allclose(got, 100 - 100 / (1 + g / l), rtol=1e-10)


def test_rsi_without_losses_or_moves(spark):
    assert column(ind.rsi(daily(spark, [1.0, 2.0, 3.0]), ["close"], [2], "day"), "close_2window_rsi")[1:] == [100.0, 100.0]
    assert column(ind.rsi(daily(spark, [1.0, 1.0, 1.0]), ["close"], [2], "day"), "close_2window_rsi") == [None] * 3


def test_simple_rsi_matches_pandas(spark):
    rng = np.random.default_rng(6)
    close = pd.Series(rng.normal(0, 1, 200).cumsum() + 50).round(2)
    df = daily(spark, close.tolist()).withColumn("open", F.col("close") - 0.25)
    out = ind.simple_rsi(df, [9], "day", [1, 5])
    for n in (1, 5):
        last = close.where(np.arange(len(close)) >= n - 1)
        d = last.diff()
        g = d.where(d > 0, 0).rolling(9, min_periods=1).mean()
        l = (-d.where(d < 0, 0)).rolling(9, min_periods=1).mean()
        got = np.array(column(out, f"close_prev_rsi_9_{n}T"), dtype=float)
        np.testing.assert_allclose(got, 100 - 100 / (1 + g / l), rtol=1e-9)


def test_macd_pairs_are_ordered_by_window():
    cols = ["close_ema_26m", "close_ema_2m", "close_ema_12m"]
    assert ind.macd_pairs(cols)[0] == ("close_ema_2m", "close_ema_12m") and len(ind.macd_pairs(cols)) == 3


def test_bins_are_anchored_at_the_first_midnight(spark):
    df = bars(
        spark,
        ["2024-01-02 09:30", "2024-01-02 09:31", "2024-01-03 00:01", "2024-01-05 10:00"],
        [1.0, 2.0, 3.0, 4.0],
    )
    out = prep.resample(df, 25, keep_unaligned=True)
    assert column(out, "bar_ts") == [
        datetime(2024, 1, 2, 9, 10), datetime(2024, 1, 2, 23, 45), datetime(2024, 1, 5, 9, 40)
    ]
    assert column(out, "close") == [2.0, 3.0, 4.0]
    assert prep.resample(df, 25).count() == 0


def test_each_symbol_has_its_own_origin(spark):
    late = bars(spark, ["2024-01-03 00:05"], [1.0], symbol="t")
    df = bars(spark, ["2024-01-02 00:00", "2024-01-03 00:05"], [1.0, 2.0]).unionByName(late)
    out = prep.resample(df, 25, keep_unaligned=True).where("symbol = 't'")
    assert column(out, "bar_ts") == [datetime(2024, 1, 3, 0, 0)]


def test_empty_day_bins_stay(spark):
    out = prep.resample_days(bars(spark, ["2024-01-02", "2024-01-08"], [1.0, 2.0], [1.0, 2.0]), 2)
    assert column(out, "open") == [1.0, None, None, 2.0]
    assert column(out, "volume") == [1.0, 0.0, 0.0, 2.0]


def test_fill_repeats_the_bar_with_its_volume(spark):
    df = bars(spark, ["2024-01-02 09:30", "2024-01-02 09:33", "2024-01-03 09:30"], [1.0, 2.0, 5.0], [10.0, 20.0, 1.0])
    out = prep.fill_minutes(df)
    assert column(out, "close") == [1.0, 1.0, 1.0, 2.0, 5.0]
    assert column(out, "volume") == [10.0, 10.0, 10.0, 20.0, 1.0]
    assert column(prep.fill_minutes(df, zero_volume=True), "volume") == [10.0, 0.0, 0.0, 20.0, 1.0]


def test_daylight_saving_days(spark):
    stamps = ["2024-03-10 06:59", "2024-03-10 07:00", "2024-11-03 05:30", "2024-11-03 06:30"]
    df = spark.createDataFrame([(datetime.fromisoformat(t),) for t in stamps], "t timestamp_ntz")
    got = [r[0] for r in df.select(times.to_eastern(F.col("t"))).collect()]
    assert [g.strftime("%m-%d %H:%M") for g in got] == ["03-10 01:59", "03-10 03:00", "11-03 01:30", "11-03 01:30"]


def test_session_bounds_are_half_open(spark):
    df = bars(spark, ["2024-01-02 09:29", "2024-01-02 09:30", "2024-01-02 15:59", "2024-01-02 16:00"], [1.0] * 4)
    assert column(prep.with_market_open(df), "market_open") == [False, True, True, False]


def test_missing_prices_raise_or_go_aside(spark):
    df = daily(spark, [1.0, None]).selectExpr("*", "close AS open", "close AS high", "close AS low")
    with pytest.raises(ValueError, match="open"):
        prep.require_prices(df)
    good, bad = prep.quarantine(df)
    assert (good.count(), bad.count()) == (1, 1)


def test_local_extrema_counts(spark):
    out = intraday.local_extrema(daily(spark, [1.0, 2.0, 3.0, 1.0, 5.0]), "day", [2])
    assert column(out, "local_max_2") == [False, False, True, False, True]
    out = intraday.with_extrema_counts(out, "day", [2])
    assert column(out, "cumulative_local_max_2") == [0, 0, 1, 1, 2]
    assert column(out, "time_since_prev_max_2") == [0, 1, 0, 1, 0]


def test_running_day_high_keeps_nulls(spark):
    stamps = [f"2024-01-02 09:3{i}" for i in range(4)]
    df = prep.with_market_open(bars(spark, stamps, [1.0, 3.0, None, 2.0]))
    assert column(intraday.with_day_extremes(df), "max_today") == [1.0, 3.0, None, 3.0]


def test_one_hot_direction(spark):
    out = intraday.one_hot_direction(intraday.directions(daily(spark, [1.0, 2.0, 1.0, 1.0]), "day"))
    assert column(out, "up") == [False, True, False, False]
    assert column(out, "no change") == [True, False, False, True]
    assert "direction" not in out.columns


def label_by_hand(y, rule):
    """Row by row, as the rule reads."""
    out = []
    for i, price in enumerate(y):
        if i < rule.prev_points or i > len(y) - max(rule.high_window, rule.low_window):
            out.append("C")
            continue
        slope = np.polyfit(np.arange(rule.prev_points), y[i - rule.prev_points : i], 1)[0]
        high, low = max(y[i + 1 : i + 1 + rule.high_window]), min(y[i + 1 : i + 1 + rule.low_window])
        if slope < rule.negative_slope and high > price * (1 + rule.rise):
            out.append("A")
        elif slope > rule.positive_slope and low < price * (1 - rule.drop):
            out.append("B")
        else:
            out.append("C")
    return out


def test_reversal_labels_match_the_rule(spark):
    rng = np.random.default_rng(8)
    stamps, y, want = [], [], []
    rule = labels.ReversalRule()
    for d, n in enumerate([120, 35, 20, 400]):
        day = (400 + rng.normal(0, 0.2, n).cumsum()).tolist()
        y += day
        want += label_by_hand(day, rule)
        stamps += [str(datetime(2024, 1, 2 + d, 9, 0) + timedelta(minutes=i)) for i in range(n)]
    out = labels.reversal_labels(bars(spark, stamps, y).withColumn("close_sma_5m", F.col("close")), rule=rule)
    got = column(out, "category")
    assert got == want and set(got) == {"A", "B", "C"}
    assert out.where("category = 'A'").select("mapped_category").distinct().collect()[0][0] == 0


def test_future_window_crosses_blocks(spark):
    stamps = [str(datetime(2024, 1, 2) + timedelta(minutes=i)) for i in range(5)]
    out = labels.future_window_labels(bars(spark, stamps, [1.0, 5.0, 2.0, 4.0, 3.0]), "minute", size=2)
    assert column(out, "future_high") == [5.0, 4.0, 4.0, None, None]


def test_threshold_decisions(spark):
    df = spark.createDataFrame([(0.2, 0.3, 0.5), (0.4, 0.35, 0.25)], "p0 double, p1 double, p2 double")
    cols = ["p0", "p1", "p2"]
    assert [r[0] for r in df.select(evaluate.threshold_argmax(cols, F.lit(0.5))).collect()] == [2, 0]
    assert [r[0] for r in df.select(evaluate.argmax(cols)).collect()] == [2, 0]
    decided = evaluate.confident_category({"A": "p0", "B": "p1", "C": "p2"}, 0.33)
    assert [r[0] for r in df.select(decided).collect()] == ["C", "A"]


def test_scores_by_hand(spark):
    # Rows: actual; columns: predicted.
    counts = [[134, 0, 389], [0, 24, 324], [68, 34, 6707]]
    pairs = [(a, p) for a, row in enumerate(counts) for p, n in enumerate(row) for _ in range(n)]
    df = spark.createDataFrame(pd.DataFrame(pairs, columns=["actual", "pred"]))
    score = evaluate.summary_scores(df, [0, 1, 2]).first()
    assert round(score["accuracy"], 3) == 0.894
    recalls = [134 / 523, 24 / 348, 6707 / 6809]
    np.testing.assert_allclose(score["balanced_accuracy"], np.mean(recalls))
    np.testing.assert_allclose(score["weighted_recall"], score["accuracy"])
    report = {r["label"]: r for r in evaluate.classification_report(df, [0, 1, 2]).collect()}
    assert report["1"]["support"] == 348 and report["macro avg"]["support"] == 7680
    assert [list(r)[1:] for r in evaluate.confusion_matrix(df, [0, 1, 2]).orderBy("actual").collect()] == counts


def test_correlation_of_a_constant_is_null(spark):
    df = daily(spark, [1.0, 2.0, 4.0]).withColumn("flat", F.lit(1.0))
    got = {(r[1], r[2]): r[3] for r in evaluate.correlations(df, ["close", "flat"]).collect()}
    assert got[("close", "flat")] is None and round(got[("close", "close")], 12) == 1


def test_correlations_are_pairwise_complete(spark):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame(rng.normal(1e5, 3, (500, 4)), columns=list("abcd"))
    pdf["b"] += pdf["a"]
    pdf = pdf.mask(rng.random(pdf.shape) < 0.2)
    df = spark.createDataFrame(pdf).select(*[F.nanvl(c, F.lit(None)).alias(c) for c in "abcd"])
    got = evaluate.correlations(df.repartition(5), list("abcd"), by=[]).toPandas()
    got = got.pivot(index="from_col", columns="to_col", values="correlation")
    np.testing.assert_allclose(got.to_numpy(), pdf.corr().to_numpy(), rtol=1e-9)


def test_training_table_skips_or_rejects_other_keys(spark):
    base = daily(spark, [1.0, 2.0, 3.0])
    short = base.limit(2).withColumn("extra", F.lit(1))
    full = base.withColumn("note", F.lit("text")).withColumn("ok", F.lit(2))
    target = base.drop("close").withColumn("mapped_category", F.lit(0)).withColumn("future_highs", F.lit(1.0))
    out, used = assemble.training_table(base, {"short": short, "full": full}, target)
    assert used == ["full"]
    assert out.columns == ["symbol", "bar_ts", "close", "ok", "mapped_category"]
    with pytest.raises(ValueError, match="keys"):
        assemble.training_table(base, {}, short)


def test_date_slice_is_inclusive_on_both_ends(spark):
    rows = [(datetime(2024, 1, 1) + timedelta(hours=12 * i),) for i in range(6)]
    df = spark.createDataFrame(rows, "t timestamp_ntz")
    assert df.where(times.in_date_slice(F.col("t"), last="2024-01-02")).count() == 4
    assert df.where(times.in_date_slice(F.col("t"), "2024-01-02", "2024-01-02")).count() == 2


def test_random_business_day(spark):
    days = times.days_between(spark, "2024-11-05", "2024-11-11", business_only=True)
    assert days.count() == 5
    first = times.random_day(days, 3).collect()
    assert first == times.random_day(days, 3).collect()


def test_name_grammar():
    assert names.split_duration("30min") == (30, "min")
    with pytest.raises(ValueError):
        names.split_duration("min30")
    assert names.by_first_number(["a_20m", "a_3m"]) == ["a_3m", "a_20m"]


@pytest.mark.parametrize("fmt", ["parquet", "csv", "json"])
def test_landed_bar_formats(spark, tmp_path, fmt):
    rows = [("s", datetime(2024, 7, 1, 14, 30), 1.0, 2.0, 0.5, 1.5, 10.0, 3.0, 1.2)]
    df = spark.createDataFrame(rows, sources.RAW_BAR_SCHEMA)
    path = str(tmp_path / fmt)
    writer = df.write.option("header", True) if fmt == "csv" else df.write
    writer.format(fmt).save(path)
    local = prep.localize(sources.read_bars(spark, path, fmt))
    assert local.select("bar_ts", "vwap").collect()[0] == (datetime(2024, 7, 1, 10, 30), 1.2)


def test_versions_survive_a_failed_write(spark, tmp_path):
    root = str(tmp_path / "table")
    storage.write_version(daily(spark, [1.0]), root)
    broken = daily(spark, [1.0]).withColumn("x", F.expr("raise_error('no')"))
    with pytest.raises(Exception):
        storage.write_version(broken, root)
    assert storage.read_version(spark, root).count() == 1
    storage.write_version(daily(spark, [1.0, 2.0]), root)
    assert storage.read_version(spark, root).count() == 2


def test_catalog_upsert_replaces_by_key(spark):
    df = daily(spark, [1.0])
    old = catalog.entry(df, "x/stock_bars_2min_base_avg.parquet")
    new = catalog.entry(df.withColumn("more", F.lit(1)), "y/stock_bars_2min_base_avg.parquet")
    other = catalog.entry(df, "x/stock_bars_1D.parquet")
    out = catalog.upsert(old.unionByName(other), new)
    assert {(r["name"], r["path"][0], len(r["cols"])) for r in out.collect()} == {
        ("stock_bars_2min_base_avg", "y", 4), ("stock_bars_1D", "x", 3)
    }
    assert catalog.lookup(out, "stock_bars_2min_base_avg", "2min").count() == 1
    assert catalog.by_period(out).count() == 2


def test_duplicate_bars_are_reported(spark):
    df = daily(spark, [1.0, 2.0])
    twice = df.unionByName(df.limit(1))
    assert prep.duplicate_bars(df).count() == 0
    assert [r["copies"] for r in prep.duplicate_bars(twice).collect()] == [2]


def test_short_days_stay_undecided(spark):
    stamps = [str(datetime(2024, 1, 2, 9, 0) + timedelta(minutes=i)) for i in range(25)]
    df = bars(spark, stamps, [400.0 - i for i in range(25)]).withColumn("close_sma_5m", F.col("close"))
    out = labels.reversal_labels(df)
    assert set(column(out, "category")) == {"C"} and set(column(out, "slopes")) == {None}


def test_stages_live_in_the_shared_folder(spark):
    kept = storage.stage(daily(spark, [1.0, 2.0]))
    folder = kept.inputFiles()[0].removeprefix("file://")
    assert folder.startswith(storage.shared_folder(spark))
    assert kept.count() == 2
    storage.clear_stages(spark)
    assert not storage.exists(spark, folder)


def test_correlations_of_groups_far_apart(spark):
    import random

    rng = random.Random(1)
    rows = []
    for symbol, base, sd in (("far", 1e7, 0.01), ("near", 100.0, 1.0), (None, -3.0, 1e-3)):
        for _ in range(400):
            x = rng.gauss(0, sd)
            rows.append((symbol, base + x, base + x + rng.gauss(0, sd / 10), 0.1, None if rng.random() < 0.3 else x))
    df = spark.createDataFrame(rows, "symbol string, a double, b double, c double, d double").repartition(6)
    found = {(r.symbol, r.from_col, r.to_col): r.correlation for r in evaluate.correlations(df, ["a", "b", "c", "d"]).collect()}
    for r in df.groupBy("symbol").agg(F.corr("a", "b").alias("ab"), F.corr("a", "d").alias("ad")).collect():
        assert abs(found[r.symbol, "a", "b"] - r.ab) < 1e-6 and abs(found[r.symbol, "d", "a"] - r.ad) < 1e-6
        assert found[r.symbol, "a", "c"] is None and found[r.symbol, "c", "c"] is None
        assert abs(found[r.symbol, "a", "a"] - 1) < 1e-9


def test_first_and_last_within_a_minute(spark):
    rows = [("x", "2024-01-02 10:00:10", 1.0), ("x", "2024-01-02 10:00:50", 5.0), ("x", "2024-01-02 10:00:30", 3.0)]
    df = spark.createDataFrame(rows, "symbol string, t string, v double").selectExpr(
        "symbol", "cast(t AS timestamp_ntz) AS bar_ts", "v AS open", "v AS high", "v AS low", "v AS close"
    )
    bar = prep.resample(df, 5).first()
    assert (bar.open, bar.high, bar.low, bar.close) == (1.0, 5.0, 1.0, 5.0)
    day = prep.daily_from_minutes(df).first()
    assert (day.open, day.close) == (1.0, 5.0)


def test_random_day_does_not_depend_on_partitions(spark):
    days = times.days_between(spark, "2024-01-01", "2024-12-31")
    assert len({times.random_day(days.repartition(n), 5).first()[0] for n in (1, 4, 16)}) == 1
