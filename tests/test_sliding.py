"""Wide frames against Spark's own windows and a version that looks at every row of a frame."""

import math
import time

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tickloom.plans.sliding import Extreme, Slope, extremes, sliding, slopes


def plain(values, f):
    out = []
    for i in range(len(values)):
        inside = [(j, values[j]) for j in range(i + f.first, i + f.last + 1) if 0 <= j < len(values)]
        there = [(j, v) for j, v in inside if not math.isnan(v)]
        if isinstance(f, Extreme):
            out.append((max if f.largest else min)(v for _, v in there) if len(there) >= max(1, f.least) else math.nan)
        elif len(there) < max(2, f.least) or (f.whole and len(inside) < f.last - f.first + 1):
            out.append(math.nan)
        else:
            x, y = np.array(there, dtype=float).T
            out.append(float(((x - x.mean()) * (y - y.mean())).sum() / ((x - x.mean()) ** 2).sum()))
    return out


@pytest.mark.parametrize("seed", range(6))
def test_kernels_look_at_the_whole_frame(seed):
    random = np.random.default_rng(seed)
    for n in (0, 1, 2, 7, 50):
        values = np.round(random.normal(100, 5, n), 2)
        values[random.random(n) < 0.2 * (seed % 3)] = np.nan
        for first, last in [(-3, -1), (1, 4), (-2, 2), (0, 0), (-80, -1), (1, 80), (3, 60), (-60, -55)]:
            for f in (Extreme("y", "x", first, last, seed % 2 == 0, 1 + seed % 3), Slope("y", "x", first, last, 2, seed % 2 == 0)):
                got = (extremes if isinstance(f, Extreme) else slopes)(values, f)
                np.testing.assert_allclose(got, plain(values, f), rtol=1e-9, atol=1e-10, err_msg=f"{n} {f}")


def bars(spark, rows):
    ts = F.expr("timestampadd(MINUTE, cast(id * 3 AS int), TIMESTAMP_NTZ'2024-01-01 00:00:00')")
    y = F.when(F.col("id") % 11 != 5, F.round(F.sin(F.col("id") * 1.7) * 50 + 100, 2))
    return spark.range(rows).select(F.explode(F.array(F.lit("a"), F.lit("b"))).alias("symbol"), ts.alias("bar_ts"), y.alias("y"), F.lit("text").alias("block"))


def same(got, want):
    a, b = (sorted(df.collect(), key=lambda r: (r["symbol"], r["bar_ts"])) for df in (got, want.select(*got.columns)))
    assert len(a) == len(b)
    for x, y in zip(a, b):
        for name, u, v in zip(got.columns, x, y):
            assert u == v or (isinstance(u, float) and isinstance(v, float) and math.isclose(u, v, rel_tol=1e-9, abs_tol=1e-10)), (name, x, y)


def test_series_blocks_and_days_equal_windows(spark):
    df = bars(spark, 1200)
    series = Window.partitionBy("symbol").orderBy("bar_ts")
    day = Window.partitionBy("symbol", F.to_date("bar_ts")).orderBy("bar_ts")
    frames = [Extreme("y", "top", -40, -1), Extreme("y", "low", 1, 300, False, 250), Slope("y", "slope", -25, -1)]
    position = F.row_number().over(series)
    for by_day, w in ((False, series), (True, day)):
        count = F.count("y").over(w.rowsBetween(1, 300))
        want = df.withColumn("_x", position).withColumns({
            "top": F.max("y").over(w.rowsBetween(-40, -1)),
            "low": F.when(count >= 250, F.min("y").over(w.rowsBetween(1, 300))),
            "slope": F.when(F.count(F.lit(1)).over(w.rowsBetween(-25, -1)) == 25, F.regr_slope("y", "_x").over(w.rowsBetween(-25, -1))),
        })
        for block in (64, 8192):
            same(sliding(df, frames, "minute", by_day, block), want)


def test_empty_tables_and_refused_frames(spark):
    none = bars(spark, 5).limit(0)
    assert sliding(none, [Extreme("y", "top", -40, -1)], "minute").columns == [*none.columns, "top"]
    assert sliding(none, [Slope("y", "s", -40, -1)], "minute", by_day=True).count() == 0
    for frame in (Extreme("y", "block", -2, -1), Extreme("y", "top", 2, 1)):
        with pytest.raises(ValueError, match="empty frames"):
            sliding(none, [frame], "minute")


def test_time_does_not_grow_with_the_frame():
    values = np.random.default_rng(1).normal(size=200_000)

    def seconds(width):
        best = math.inf
        for _ in range(3):
            begin = time.perf_counter()
            extremes(values, Extreme("y", "x", -width, -1))
            slopes(values, Slope("y", "x", -width, -1))
            best = min(best, time.perf_counter() - begin)
        return best

    assert seconds(20_000) < 3 * seconds(20)
