"""The whole batch on a small root, then one walk-forward step."""

from pyspark.sql import functions as F

from tickloom.operators import training as tr
from tickloom.plans import batch as b
from tickloom.sources import bars as sources
from tickloom.sources import storage

SF = "/root/testdata/sf0.001"


def test_batch_end_to_end(spark, tmp_path):
    events = sources.table(spark, SF, "events")
    orders = sources.table(spark, SF, "orders")
    minute = sources.minute_bars(events).where("symbol in ('click', 'view')")
    short = F.col("bar_ts") < F.lit("2024-01-06").cast("timestamp_ntz")
    first = {"minute": minute.where(short), "day": sources.day_bars(orders)}
    plan = b.Batch(
        root=str(tmp_path / "store"), symbols=["click", "view"], durations=["1min", "30min", "1D", "30D"],
        training_features=("rsi", "otherfeatures"),
    )
    b.refresh(spark, plan, first, "2024-01-01")
    assert b.raw_bars(spark, plan, "minute").count() == minute.where(short).count()
    done = b.prepare_bars(spark, plan)
    assert done == ["1min", "1D", "30min", "30D"]
    b.technical_features(spark, plan, "1min")
    b.technical_features(spark, plan, "30min")
    b.custom_features(spark, plan)
    b.label_bars(spark, plan)
    table = b.training_table(spark, plan)
    base = spark.read.parquet(plan.path("feature_prep", "1min", "_base_avg"))
    assert table.count() == base.count()
    assert {"mapped_category", "close_14window_rsi", "close_lag_15", "up", "slopes"} <= set(table.columns)
    assert not {"future_highs", "category"} & set(table.columns)
    assert b.stored_training_table(spark, plan).columns == table.columns

    listed = storage.read_version(spark, f"{plan.root}/catalog")
    assert listed.count() == listed.select("store", "time_period", "name").distinct().count()

    columns = ["symbol", "bar_ts", "market_open", "close", "close_sma_5m", "close_14window_rsi", "mapped_category"]
    # Two of three classes are enough for the forest, but every class needs a row.
    small = table.select(*columns).withColumn("mapped_category", F.pmod(F.hour("bar_ts"), F.lit(3)))

    def fit(train):
        return tr.fit_forest(train, trees=3, depth=2)

    steps = list(tr.walk_forward(small, tr.folds("2024-01-04", "2024-01-09"), fit))
    assert [fold.date for fold, _, _ in steps] == ["2024-01-04", "2024-01-05"]
    report = steps[0][2]["test_full"]
    assert report.columns[:7] == ["symbol", "bar_ts", "0", "1", "2", "pred", "actual"]
    worst = report.select(F.max(F.abs(F.col("0") + F.col("1") + F.col("2") - 1)).alias("d")).first()["d"]
    assert worst < 1e-9

    rows = tr.with_features(small, tr.feature_columns(small)).withColumn(
        "held_out", ~tr.is_training_row(["symbol", "bar_ts"])
    )
    boosted = tr.fit_boosted(rows, rounds=2, depth=2, validation="held_out")
    scored = tr.class_probabilities(boosted, rows)
    assert scored.where("abs(p0 + p1 + p2 - 1) > 1e-9").count() == 0
    assert tr.importances(boosted, tr.feature_columns(small), rows).count() == len(tr.feature_columns(small))


def test_refresh_keeps_earlier_rows_of_a_shared_folder(spark, tmp_path):
    bars = sources.day_bars(sources.table(spark, SF, "orders")).select("symbol", "bar_ts", "close")
    path = storage.write_partitioned(bars, str(tmp_path / "days"), "year")
    new = storage.trim(bars, "1999-05-10").where("symbol <> '5-LOW'").withColumn("close", F.col("close") + 1)
    want = sorted(storage.refresh_window(bars, new, "1999-05-10").collect())
    for _ in range(2):
        storage.refresh_partitions(spark, path, new, "1999-05-10", "year")
        assert sorted(storage.read_partitioned(spark, path).select("symbol", "bar_ts", "close").collect()) == want


def test_refresh_is_idempotent_and_drops_vanished_days(spark, tmp_path):
    bars = sources.minute_bars(sources.table(spark, SF, "events")).select("symbol", "bar_ts", "close")
    path = storage.write_partitioned(bars, str(tmp_path / "bars"))
    new = storage.trim(bars, "2024-01-20").where("symbol <> 'click'").withColumn("close", F.col("close") * 2)
    want = storage.refresh_window(bars, new, "2024-01-20").collect()
    for _ in range(2):
        storage.refresh_partitions(spark, path, new, "2024-01-20")
        got = storage.read_partitioned(spark, path).select("symbol", "bar_ts", "close").collect()
        assert sorted(got) == sorted(want)


def test_odd_symbols_stay_and_a_failed_refresh_changes_nothing(spark, tmp_path, monkeypatch):
    rows = [(s, f"2024-01-0{d} 10:00:00", float(d)) for s in ("BTC/USD", "0700", "a=b%c:d", None) for d in (1, 2, 3)]
    bars = spark.createDataFrame(rows, "symbol string, t string, close double").selectExpr("symbol", "cast(t AS timestamp_ntz) AS bar_ts", "close")
    path = storage.write_partitioned(bars, str(tmp_path / "odd"))

    def now():
        return sorted(storage.read_partitioned(spark, path).select("symbol", "bar_ts", "close").collect(), key=str)

    assert now() == sorted(bars.collect(), key=str)
    new = storage.trim(bars, "2024-01-02").where("symbol IS NULL")
    monkeypatch.setattr(storage, "write_version", lambda *_: (_ for _ in ()).throw(OSError("lost")))
    try:
        storage.refresh_partitions(spark, path, new, "2024-01-02")
    except OSError:
        pass
    assert now() == sorted(bars.collect(), key=str)
    monkeypatch.undo()
    storage.refresh_partitions(spark, path, new, "2024-01-02")
    want = [r for r in bars.collect() if r.symbol is None or str(r.bar_ts) < "2024-01-02"]
    assert now() == sorted(want, key=str)
    assert storage.read_partitioned(spark, path, "2024-01-03").count() == 1


def test_a_table_with_other_keys_is_left_out_and_listed(spark, tmp_path):
    plan = b.Batch(root=str(tmp_path / "keys"), label_duration="5min", training_features=("rsi", "macd"))
    rows = spark.range(4).selectExpr("'a' AS symbol", "timestampadd(MINUTE, id * 5, TIMESTAMP_NTZ'2024-01-02 10:00:00') AS bar_ts", "id * 1.0D AS close")
    tables = {
        ("feature_prep", "_base_avg"): rows,
        ("feature_prep", "_base_rsi"): rows.withColumnRenamed("close", "rsi"),
        ("feature_prep", "_base_macd"): rows.withColumnRenamed("close", "signal").limit(3),
        ("dependent_variable", "_base_avg"): rows.selectExpr("symbol", "bar_ts", "1 AS mapped_category", "2.0D AS future_highs"),
    }
    for (folder, suffix), table in tables.items():
        table.write.parquet(plan.path(folder, "5min", suffix))
    assert b.training_table(spark, plan).columns == ["symbol", "bar_ts", "close", "rsi", "mapped_category"]
    assert "future_highs" in b.training_table(spark, plan, keep_future=True).columns
    listed = storage.read_version(spark, f"{plan.root}/catalog").where("store = 'left_out'").collect()
    assert [(r["time_period"], r["name"]) for r in listed] == [("5min", "stock_bars_5min_base_macd")]
    assert b.stored_training_table(spark, plan).columns[-1] == "future_highs"
