"""The batch from the first changed day on.

Every stage's table is in folders by the chunk of its bars (a day, month or year), and beside it are small tables with
a row per chunk: how many bars it has, and the summaries through which unbounded features pass from chunk to chunk
(affine states of the exponential averages, counts of extrema, the day's final counts and extremes). A run
with new bars from a day on reads the bars of the chunks from that day on, the few chunks before that bounded frames look back to,
and the summaries of all earlier chunks; it replaces the chunks it has computed and leaves the older folders as they are. The first run
is the same with nothing before it.

Each table is replaced as a whole by the list of its folders, so a run that fails leaves finished tables, and repeating it
changes nothing more.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.functions import times
from tickloom.functions.names import columns_with, split_duration
from tickloom.operators import assemble, intraday, labels, prep
from tickloom.operators import indicators as ind
from tickloom.plans.batch import PERIODS, Batch, grain_of, refresh, with_market_open
from tickloom.plans.blocks import chunk_key, row_features
from tickloom.plans.scan import Ewm, count_chunks, ewm_chunks, ewm_scan
from tickloom.sources import catalog, storage

GRANULARITIES = {"1min": "minute", "60min": "hour", "1D": "day"}


def chunk_at(day: str, grain: str) -> int:
    """Chunk number of a date."""
    date = dt.date.fromisoformat(day)
    return {"minute": (date - dt.date(1970, 1, 1)).days, "hour": date.year * 12 + date.month, "day": date.year}[grain]


def chunk_start(chunk: int, grain: str) -> str:
    """First date of a chunk."""
    if grain == "minute":
        return str(dt.date(1970, 1, 1) + dt.timedelta(days=chunk))
    return str(dt.date((chunk - 1) // 12, (chunk - 1) % 12 + 1, 1) if grain == "hour" else dt.date(chunk, 1, 1))


def _folder_date(grain: str) -> Column:
    """The folder of a chunk, as a date."""
    chunk = F.col("_chunk")
    if grain == "minute":
        return F.date_from_unix_date(chunk)
    one = F.lit(1)
    if grain == "hour":
        return F.make_date(F.floor((chunk - 1) / 12).cast("int"), ((chunk - 1) % 12 + 1).cast("int"), one)
    return F.make_date(chunk, one, one)


@dataclass(frozen=True)
class Series:
    """A table of bars by chunk, seen from the first chunk that changes."""

    spark: SparkSession
    root: str
    grain: str
    first: int

    @property
    def start(self) -> str:
        return chunk_start(self.first, self.grain)

    def _earlier(self, name: str) -> DataFrame | None:
        path = f"{self.root}/{name}"
        if not storage.versions(self.spark, path):
            return None
        return storage.read_version(self.spark, path).where(F.col("_chunk") < self.first)

    def known(self, name: str, fresh: DataFrame) -> DataFrame:
        """A summary of all chunks: of the older ones as kept, of the others ``fresh``; kept as a new version."""
        old = self._earlier(name)
        if old is None and storage.is_partitioned(self.spark, self.root):
            raise ValueError(f"{self.root} has rows but no {name}: run again from the first day")
        storage.write_version(fresh if old is None else old.unionByName(fresh), f"{self.root}/{name}")
        return storage.read_version(self.spark, f"{self.root}/{name}")

    def replace(self, rows: DataFrame) -> DataFrame:
        """Puts the rows in place of the chunks from the first one on; returns them as stored."""
        old, rows = self._earlier("chunks"), storage.stage(rows, "rows")  # dealing by ranges reads its input twice
        if storage.is_partitioned(self.spark, self.root):
            storage.refresh_partitions(self.spark, self.root, rows, self.start, PERIODS[self.grain])
        else:
            storage.write_partitioned(rows, self.root, PERIODS[self.grain])
        now = self.rows()
        counts = now.groupBy("symbol", chunk_key(self.grain).alias("_chunk")).agg(
            F.count(F.lit(1)).alias("_n"), F.min(times.epoch_day(F.col("bar_ts"))).alias("_first_day")
        )
        storage.write_version(counts if old is None else old.unionByName(counts), f"{self.root}/chunks")
        return now

    def rows(self) -> DataFrame:
        """The rows from the first chunk on; older folders are not read."""
        return storage.read_partitioned(self.spark, self.root, self.start).drop("date")

    def whole(self) -> DataFrame:
        return storage.read_partitioned(self.spark, self.root).drop("date")

    def first_days(self) -> DataFrame:
        """symbol, _first_day: a row per series, from the counts of its chunks."""
        counts = storage.read_version(self.spark, f"{self.root}/chunks")
        return counts.groupBy("symbol").agg(F.min("_first_day").alias("_first_day"))

    def before(self, n: int) -> DataFrame:
        """symbol, _chunk: the older chunks of each series that hold its last ``n`` rows before the first chunk."""
        counts = storage.read_version(self.spark, f"{self.root}/chunks").where(F.col("_chunk") < self.first)
        later = Window.partitionBy("symbol").orderBy(F.desc("_chunk")).rowsBetween(Window.unboundedPreceding, -1)
        return counts.withColumn("_later", F.coalesce(F.sum("_n").over(later), F.lit(0))).where(F.col("_later") < n).select("symbol", "_chunk")

    def with_rows_before(self, n: int) -> DataFrame:
        """The rows from the first chunk on, and at least the last ``n`` rows of each series before them."""
        needed = storage.stage(self.before(n), "needed")
        folders = needed.select(_folder_date(self.grain).alias("date"))
        rows = storage.read_partitioned(self.spark, self.root, self.start, also=folders).drop("date")
        rows = rows.withColumn("_chunk", chunk_key(self.grain))
        older = rows.where(F.col("_chunk") < self.first).join(needed, ["symbol", "_chunk"], "left_semi")
        return rows.where(F.col("_chunk") >= self.first).unionByName(older.select(*rows.columns)).drop("_chunk")

    def only_changed(self, rows: DataFrame) -> DataFrame:
        return rows.where(F.col("bar_ts") >= F.lit(self.start).cast("timestamp_ntz"))

    def scanned(self, rows: DataFrame, specs: list[Ewm], name: str) -> DataFrame:
        """Averages of the changed rows; the averages that enter them come from the kept chunk states."""
        return ewm_scan(rows, specs, self.grain, self.known(name, ewm_chunks(rows, specs, self.grain)))


@dataclass(frozen=True)
class Update:
    """One run of the batch with all bars from ``start`` on replaced."""

    spark: SparkSession
    batch: Batch
    start: str
    #: Store and columns of the tables made so far, by path.
    made: dict[str, tuple[str, list[str]]] = field(default_factory=dict)

    def keep(self, out: Series, rows: DataFrame, store: str = "feature_store") -> DataFrame:
        now = out.replace(rows)
        self.made[out.root] = (store, now.columns)
        return now

    def series(self, folder: str, duration: str, suffix: str = "", start: str | None = None) -> Series:
        grain = grain_of(duration)
        return Series(self.spark, self.batch.path(folder, duration, suffix), grain, chunk_at(start or self.start, grain))

    # -- bars -------------------------------------------------------------------------------

    def source_bars(self, duration: str) -> Series | None:
        """Prepared bars of a landed granularity."""
        granularity = GRANULARITIES[duration]
        out = self.series("data_prep", duration)
        root = f"{self.batch.root}/raw/stock_bars_{granularity}"
        if not storage.is_partitioned(self.spark, root):
            return None
        bars = prep.require_prices(storage.read_partitioned(self.spark, root, out.start).drop("date"))
        if granularity == "minute":
            bars = prep.fill_minutes(bars)
        out.replace(bars if granularity == "day" else with_market_open(bars, self.batch))
        return out

    def resampled(self, base: Series, durations: list[str]) -> dict[str, str]:
        """Longer bars from stored ones; returns each length's first changed day.

        A bin may begin before the first changed bar: bins are made again from a day, or for bars of days from so many days before,
        or the last bar before that, whose empty followers may now end elsewhere.
        """
        starts = {}
        for duration in durations:
            size, unit = split_duration(duration)
            day = dt.date.fromisoformat(self.start) - dt.timedelta(days=size if unit == "D" else 1)
            if unit == "D":
                edge = F.lit(str(day)).cast("timestamp_ntz")
                latest = base.whole().where(F.col("bar_ts") < edge).groupBy("symbol").agg(F.max(F.to_date("bar_ts")).alias("day"))
                found = latest.agg(F.min("day")).first()[0]
                day = min(day, found or day)
            starts[duration] = str(day)
            out = self.series("data_prep", duration, start=starts[duration])
            bars = Series(self.spark, base.root, base.grain, chunk_at(out.start, base.grain)).rows()
            if unit == "D":
                made = prep.resample_days(bars, size, base.first_days())
            else:
                made = prep.resample_many(bars.drop("vwap"), [size], first_days=base.first_days()).drop("duration")
            out.replace(out.only_changed(made))
        return starts

    # -- features ---------------------------------------------------------------------------

    def technical_features(self, duration: str, start: str) -> None:
        size, unit = split_duration(duration)
        bars = self.series("data_prep", duration, start=start)
        keep = F.col("symbol").isin(*self.batch.symbols) if self.batch.symbols else F.lit(True)
        diffs = self.series("reduced_autocorrelation", duration, start=start)
        before = bars.with_rows_before(1).where(keep)
        fields = [f for f in ind.DIFF_FIELDS if f in before.columns]
        if "diff" in self.batch.kinds:
            self.keep(diffs, diffs.only_changed(ind.difference(before, diffs.grain)))

        windows = ind.avg_windows(size, unit)
        rsi_windows, rsi_fields = ind.rsi_plan(size, unit)
        for kind, table, columns in (("base", bars, fields), ("diff", diffs, [f"{f}_diff" for f in fields])):
            if kind not in self.batch.kinds:
                continue
            averages, rsi, macd = (self.series("feature_prep", duration, f"_{kind}_{name}", start) for name in ("avg", "rsi", "macd"))
            simple = ind.simple_averages(table.with_rows_before(max(windows)).where(keep), columns, windows, table.grain)
            simple = storage.stage(averages.only_changed(simple), "simple")
            averaged = self.keep(averages, averages.scanned(simple, ind.ema_specs(columns, windows), "states"))

            sources = rsi_fields if kind == "base" else [f.replace("close", "close_diff") for f in rsi_fields]
            if missing := set(sources) - set(averaged.columns):
                raise ValueError(f"{duration}: no columns {sorted(missing)} for the RSI")
            moves = ind.rsi_moves(averages.with_rows_before(1).select("symbol", "bar_ts", *sources), sources, rsi.grain)
            moves = storage.stage(rsi.only_changed(moves), "moves")
            smoothed = rsi.scanned(moves, ind.rsi_specs(sources, rsi_windows), "states")
            self.keep(rsi, smoothed.select("symbol", "bar_ts", *sources, *ind.rsi_values(sources, rsi_windows)))

            emas = columns_with(averaged.columns, "close_ema" if kind == "base" else "close_diff_ema")
            lines = ind.macd_lines(averaged.select("symbol", "bar_ts", *emas), emas)
            signals = macd.scanned(lines, ind.macd_specs(emas, ind.macd_signals(size, unit)), "states")
            self.keep(macd, signals.drop(*[c for c in lines.columns if c.startswith("MACD_")]))

    def custom_features(self, kind: str, start: str) -> None:
        duration = self.batch.label_duration
        table, out = self.series("feature_prep", duration, f"_{kind}_avg", start), self.series("feature_prep", duration, f"_{kind}_otherfeatures", start)
        frames = intraday.frame_features([f if kind == "base" else f"{f}_diff" for f in prep.PRICES])
        rows = row_features(table.with_rows_before(sum(f.halo for f in frames)), frames, table.grain)
        rows = storage.stage(out.only_changed(rows), "frames")
        counts = out.known("counts", count_chunks(rows, list(intraday.extrema_names()), out.grain))
        with_chunk = lambda dates: dates.withColumn("_chunk", chunk_key(out.grain, "_date"))
        finals = out.known("finals", with_chunk(intraday.day_finals(rows))).drop("_chunk")
        extremes = out.known("extremes", with_chunk(intraday.date_extremes(rows))).where(F.col("_chunk") < out.first).drop("_chunk")
        rows = intraday.with_extrema_counts(rows, out.grain, chunks=counts)
        rows = intraday.with_day_counts(rows, finals)
        rows = intraday.with_day_extremes(intraday.with_calendar_parts(rows), earlier=extremes)
        self.keep(out, intraday.one_hot_direction(rows))

    def label_bars(self, start: str) -> None:
        """Labels see no further than their day, and chunks hold whole days."""
        batch = self.batch
        out = self.series("dependent_variable", batch.label_duration, "_base_avg", start)
        rows = self.series("feature_prep", batch.label_duration, "_base_avg", start).rows()
        columns = list(dict.fromkeys(["symbol", "bar_ts", *prep.PRICES, "close_ema_5m", "close_sma_5m", batch.label_field]))
        self.keep(out, labels.reversal_labels(rows.select(*columns), batch.label_field, batch.rule), "dependent_variable")

    def training_table(self, start: str, keep_future: bool = False) -> Series:
        """Joins the changed rows of the stored tables; tables whose keys differ are an error."""
        duration, names = self.batch.label_duration, self.batch.training_features
        stored = {name: self.series("feature_prep", duration, f"_base_{name}", start).rows() for name in ("avg", *names)}
        labelled = self.series("dependent_variable", duration, "_base_avg", start).rows()
        base = stored.pop("avg")
        made, used = assemble.training_table(base, stored, labelled, keep_future)
        if left_out := set(names) - set(used):
            raise ValueError(f"other keys than the base table: {sorted(left_out)}")
        out = self.series("model/data", duration, "_base_avg" + "".join(f"_base_{name}" for name in names) + "_base_avg", start)
        self.keep(out, made, "training_files")
        return out

    def list_tables(self) -> None:
        """Catalog rows of all tables made, in one new version."""
        root = f"{self.batch.root}/catalog"
        rows = catalog.entries(self.spark, [(store, path, columns) for path, (store, columns) in self.made.items()])
        storage.update_version(self.spark, root, lambda old: rows if old is None else catalog.upsert(old, rows))


def update(spark: SparkSession, batch: Batch, new: dict[str, DataFrame], start: str, keep_future: bool = False) -> DataFrame:
    """Replaces the landed bars from the date ``start`` on by ``new`` (granularity: bars) and carries the change through all stages.

    Returns the training table. The first run creates all tables and may have any start that isn't after its bars. Durations
    without landed bars are left out; the label duration must be among those that are made.
    """
    refresh(spark, batch, new, start)
    run = Update(spark, batch, start)
    starts: dict[str, str] = {}
    for base in GRANULARITIES:
        wanted = [d for d in batch.durations if d not in GRANULARITIES and _base_of(d) == base]
        bars = run.source_bars(base) if wanted or base in batch.durations else None
        if bars is None:
            continue
        if base in batch.durations:
            starts[base] = start
        starts |= run.resampled(bars, wanted)
    if batch.label_duration not in starts:
        raise ValueError(f"no bars for the label duration {batch.label_duration}")
    for duration, first in starts.items():
        run.technical_features(duration, first)
    first = starts[batch.label_duration]
    for kind in batch.kinds:
        run.custom_features(kind, first)
    run.label_bars(first)
    training = run.training_table(first, keep_future)
    run.list_tables()
    return training.whole()


def _base_of(duration: str) -> str:
    size, unit = split_duration(duration)
    return "1D" if unit == "D" else "60min" if size > 60 else "1min"
