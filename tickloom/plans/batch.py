"""The whole batch, stage by stage, on tables below one root folder.

    raw/stock_bars_{minute|hour|day}           (symbol, date) folders, refreshed by window
    data_prep/stock_bars_{dur}.parquet         bars of every length
    reduced_autocorrelation/...                bars with first differences
    feature_prep/..._{base|diff}_{avg|rsi|macd|otherfeatures}.parquet
    dependent_variable/..._base_avg.parquet    labels
    model/data/...                             the training table
    catalog                                    one row per stored table

Every stage reads finished tables and writes new ones, so a stage can be repeated on its own.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.names import columns_with, split_duration
from tickloom.operators import assemble, intraday, labels, prep
from tickloom.operators import indicators as ind
from tickloom.sources import catalog, sessions, storage

# Folder period of the raw tables.
PERIODS = {"minute": "day", "hour": "month", "day": "year"}
DEFAULT_DURATIONS = ["1min", *prep.MINUTE_DURATIONS, "60min", *prep.HOUR_DURATIONS, "1D", *prep.DAY_DURATIONS]


@dataclass(frozen=True)
class Batch:
    """Folder and choices of one run."""

    root: str
    symbols: list[str] | None = None
    durations: list[str] = field(default_factory=lambda: list(DEFAULT_DURATIONS))
    label_duration: str = "1min"
    label_field: str = "close_sma_5m"
    rule: labels.ReversalRule = labels.ReversalRule()
    training_features: tuple[str, ...] = ("rsi", "macd", "otherfeatures")
    #: Feature tables of the bars, of their differences, or both.
    kinds: tuple[str, ...] = ("base", "diff")
    #: Folder of a stored calendar, whose sessions then say when the market is open.
    calendar: str | None = None

    def path(self, folder: str, duration: str, suffix: str = "") -> str:
        return f"{self.root}/{folder}/stock_bars_{duration}{suffix}.parquet"


def grain_of(duration: str) -> str:
    """Chunk size that keeps a few hundred to a few thousand rows per chunk."""
    size, unit = split_duration(duration)
    if unit == "D":
        return "day"
    return "minute" if size < 10 else "hour"


def _save(df: DataFrame, path: str, batch: Batch, store: str = "feature_store", period: str | None = None) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    _record(df, path, batch, store, period)
    return df.sparkSession.read.parquet(path)


def _record(df: DataFrame, path: str, batch: Batch, store: str, period: str | None = None) -> None:
    row = catalog.entry(df, path, store, period)
    storage.update_version(df.sparkSession, f"{batch.root}/catalog", lambda old: row if old is None else catalog.upsert(old, row))


def refresh(spark: SparkSession, batch: Batch, new: dict[str, DataFrame], start: str) -> None:
    """Replaces all bars from ``start`` on, per granularity; a missing table is created.

    Rows without a symbol or a time go to ``quarantine`` below the root.
    """
    for granularity, bars in new.items():
        aside = prep.unkeyed(bars)
        if aside.limit(1).count():
            storage.write_version(aside, f"{batch.root}/quarantine/{granularity}")
        bars = prep.keyed(bars)
        path = f"{batch.root}/raw/stock_bars_{granularity}"
        if storage.is_partitioned(spark, path):
            storage.refresh_partitions(spark, path, bars, start, PERIODS[granularity])
        else:
            storage.write_partitioned(bars, path, PERIODS[granularity])


def with_market_open(bars: DataFrame, batch: Batch) -> DataFrame:
    """Adds ``market_open``, from the batch's calendar or the regular hours."""
    if batch.calendar is None:
        return prep.with_market_open(bars)
    return sessions.with_sessions(bars, sessions.read(bars.sparkSession, batch.calendar)).drop("extended_open")


def raw_bars(spark: SparkSession, batch: Batch, granularity: str) -> DataFrame | None:
    path = f"{batch.root}/raw/stock_bars_{granularity}"
    return storage.read_partitioned(spark, path).drop("date") if storage.is_partitioned(spark, path) else None


def prepare_bars(spark: SparkSession, batch: Batch) -> list[str]:
    """Fills and resamples; each longer bar is built from the stored 1-minute, hour or day table."""
    done = []
    sources = {"1min": "minute", "60min": "hour", "1D": "day"}
    stored: dict[str, DataFrame] = {}
    for base, granularity in sources.items():
        bars = raw_bars(spark, batch, granularity)
        if bars is None:
            continue
        bars = prep.require_prices(bars)
        if granularity == "minute":
            bars = prep.fill_minutes(bars)
        if granularity != "day":
            bars = with_market_open(bars, batch)
        bars.write.mode("overwrite").parquet(batch.path("data_prep", base))
        stored[base] = spark.read.parquet(batch.path("data_prep", base))
        done.append(base)
    lengths: dict[str, list[str]] = {}
    for duration in batch.durations:
        size, unit = split_duration(duration)
        base = "1D" if unit == "D" else "60min" if size > 60 else "1min"
        if duration not in sources and base in stored:
            lengths.setdefault(base, []).append(duration)
    for base, durations in lengths.items():
        sizes = [split_duration(d)[0] for d in durations]
        if base != "1D":
            # All lengths from one pass over the bars.
            many = storage.stage(prep.resample_many(stored[base].drop("vwap"), sizes), "lengths")
        for duration, size in zip(durations, sizes):
            if base == "1D":
                out = prep.resample_days(stored[base], size)
            else:
                out = many.where(F.col("duration") == f"{size}min").drop("duration")
            out.write.mode("overwrite").parquet(batch.path("data_prep", duration))
    done += [d for d in batch.durations if d in {x for durations in lengths.values() for x in durations}]
    return done


def technical_features(spark: SparkSession, batch: Batch, duration: str) -> None:
    """Differences, averages, RSI and MACD signals of one bar length, for bars and differences."""
    size, unit = split_duration(duration)
    grain = grain_of(duration)
    bars = spark.read.parquet(batch.path("data_prep", duration))
    if batch.symbols:
        bars = bars.where(F.col("symbol").isin(*batch.symbols))
    fields = [f for f in ind.DIFF_FIELDS if f in bars.columns]
    diffs = ind.difference(bars, grain)
    diffs = _save(diffs, batch.path("reduced_autocorrelation", duration), batch, period=duration)

    windows = ind.avg_windows(size, unit)
    rsi_windows, rsi_fields = ind.rsi_plan(size, unit)
    for kind, table, columns in (
        ("base", bars, fields),
        ("diff", diffs, [f"{f}_diff" for f in fields]),
    ):
        if kind not in batch.kinds:
            continue
        averages = ind.moving_averages(table, columns, windows, grain)
        averages = _save(averages, batch.path("feature_prep", duration, f"_{kind}_avg"), batch)
        sources = rsi_fields if kind == "base" else [f.replace("close", "close_diff") for f in rsi_fields]
        missing = [c for c in sources if c not in averages.columns]
        if missing:
            raise ValueError(f"no averages {missing} for the RSI of {duration} bars")
        rsi = ind.rsi(averages.select("symbol", "bar_ts", *sources), sources, rsi_windows, grain)
        _save(rsi, batch.path("feature_prep", duration, f"_{kind}_rsi"), batch)
        emas = columns_with(averages.columns, "close_ema" if kind == "base" else "close_diff_ema")
        signals = ind.macd(averages.select("symbol", "bar_ts", *emas), emas, ind.macd_signals(size, unit), grain)
        _save(signals, batch.path("feature_prep", duration, f"_{kind}_macd"), batch)


def custom_features(spark: SparkSession, batch: Batch) -> None:
    for kind, suffix in (("base", ""), ("diff", "_diff")):
        if kind not in batch.kinds:
            continue
        table = spark.read.parquet(batch.path("feature_prep", batch.label_duration, f"_{kind}_avg"))
        lagged = [f"{f}{suffix}" for f in prep.PRICES]
        out = intraday.custom_features(table, lagged, grain_of(batch.label_duration))
        _save(out, batch.path("feature_prep", batch.label_duration, f"_{kind}_otherfeatures"), batch)


def label_bars(spark: SparkSession, batch: Batch) -> None:
    table = spark.read.parquet(batch.path("feature_prep", batch.label_duration, "_base_avg"))
    columns = list(dict.fromkeys(["symbol", "bar_ts", *prep.PRICES, "close_ema_5m", "close_sma_5m", batch.label_field]))
    out = labels.reversal_labels(table.select(*columns), batch.label_field, batch.rule)
    _save(out, batch.path("dependent_variable", batch.label_duration, "_base_avg"), batch, "dependent_variable")


def training_table(spark: SparkSession, batch: Batch, keep_future: bool = False) -> DataFrame:
    """Joins the stored tables; a feature table with other keys is left out and listed in the catalog as store ``left_out``."""
    duration = batch.label_duration
    base = spark.read.parquet(batch.path("feature_prep", duration, "_base_avg"))
    features = {
        name: spark.read.parquet(batch.path("feature_prep", duration, f"_base_{name}"))
        for name in batch.training_features
    }
    labelled = spark.read.parquet(batch.path("dependent_variable", duration, "_base_avg"))
    out, used = assemble.training_table(base, features, labelled, keep_future)
    for name in features.keys() - set(used):
        _record(features[name], batch.path("feature_prep", duration, f"_base_{name}"), batch, "left_out", duration)
    suffix = "_base_avg" + "".join(f"_base_{name}" for name in used) + "_base_avg"
    return _save(out, batch.path("model/data", duration, suffix), batch, "training_files", duration)


def stored_training_table(spark: SparkSession, batch: Batch) -> DataFrame:
    """The only training table of the catalog; several are an error."""
    listed = storage.read_version(spark, f"{batch.root}/catalog").where("store = 'training_files'")
    paths = [r["path"] for r in listed.select("path").limit(2).collect()]
    if len(paths) != 1:
        raise ValueError("expected exactly one training table in the catalog")
    return spark.read.parquet(paths[0])


def run(spark: SparkSession, batch: Batch, new: dict[str, DataFrame], start: str) -> DataFrame:
    """Refresh, prepare, features of the lengths asked for, labels, training table."""
    refresh(spark, batch, new, start)
    for duration in prepare_bars(spark, batch):
        if duration in batch.durations:
            technical_features(spark, batch, duration)
    custom_features(spark, batch)
    label_bars(spark, batch)
    return training_table(spark, batch)
