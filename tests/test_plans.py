"""Block plans against plain pandas on one ordered series."""

from datetime import datetime

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tickloom.plans import scan
from tickloom.plans.blocks import Mean, RowFeature, row_features, with_row_number


def series(rows_per_day, nulls=0.0, seed=7, symbols=("aa", "bb")):
    rng = np.random.default_rng(seed)
    frames = []
    for s, sym in enumerate(symbols):
        stamps = []
        for d, n in enumerate(rows_per_day):
            start = pd.Timestamp("2024-01-29") + pd.Timedelta(days=d + s)
            minutes = np.sort(rng.choice(1440, size=n, replace=False))
            stamps += [start + pd.Timedelta(minutes=int(m)) for m in minutes]
        x = 400 + rng.normal(0, 2, len(stamps)).cumsum()
        y = rng.normal(10, 5, len(stamps)).round(2)
        x[rng.random(len(x)) < nulls] = np.nan
        frames.append(pd.DataFrame({"symbol": sym, "bar_ts": stamps, "x": x, "y": y}))
    return pd.concat(frames, ignore_index=True)


def to_spark(spark, pdf):
    df = spark.createDataFrame(pdf)
    df = df.withColumn("bar_ts", F.col("bar_ts").cast("timestamp_ntz"))
    return df.withColumns({c: F.nanvl(c, F.lit(None)) for c in ("x", "y")})


def ordered(df):
    return df.orderBy("symbol", "bar_ts").toPandas().reset_index(drop=True)


DAYS = [1440, 3, 1440, 700, 1, 1200, 40]


@pytest.mark.parametrize("nulls", [0.0, 0.3, 0.97])
def test_ewm_matches_pandas(spark, nulls):
    pdf = series(DAYS, nulls)
    spans = [2, 5, 26, 200]
    specs = [scan.Ewm("x", scan.span_alpha(n), f"x{n}") for n in spans]
    specs += [scan.Ewm("y", 1 / 14, "y14", 14), scan.Ewm("x", 1 / 14, "x14", 14)]
    got = ordered(scan.ewm_scan(to_spark(spark, pdf), specs, "minute"))
    for _, want in pdf.groupby("symbol"):
        mine = got.loc[want.index]
        for n in spans:
            e = want["x"].ewm(span=n, adjust=False).mean()
            np.testing.assert_allclose(mine[f"x{n}"], e, rtol=1e-11)
        for c in ("x", "y"):
            e = want[c].ewm(alpha=1 / 14, min_periods=14, adjust=False).mean()
            np.testing.assert_allclose(mine[f"{c}14"], e, rtol=1e-11)


def test_ewm_golden_with_gaps(spark):
    values = [None, 1.0, 2.0, None, None, 5.0, 3.0]
    rows = [("s", datetime(2024, 1, 1 + i), v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "symbol string, bar_ts timestamp_ntz, x double")
    out = ordered(scan.ewm_scan(df, [scan.Ewm("x", 0.5, "e")], "day"))["e"].tolist()
    assert np.isnan(out[0])
    np.testing.assert_allclose(out[1:], [1, 1.5, 1.5, 1.5, 4.3, 3.65])


def test_ewm_long_day_series_crosses_spans(spark):
    stamps = pd.date_range("1850-01-01", "2023-12-31", freq="D", unit="us")
    x = np.random.default_rng(3).normal(100, 9, len(stamps))
    pdf = pd.DataFrame({"symbol": "s", "bar_ts": stamps, "x": x, "y": 0.0})
    got = ordered(scan.ewm_scan(to_spark(spark, pdf), [scan.Ewm("x", 2 / 201, "e")], "day"))
    np.testing.assert_allclose(got["e"], pdf["x"].ewm(span=200, adjust=False).mean(), rtol=1e-11)


def test_row_number_matches_plain_window(spark):
    df = to_spark(spark, series(DAYS))
    plain = F.row_number().over(Window.partitionBy("symbol").orderBy("bar_ts")) - 1
    checked = with_row_number(df, "minute").withColumn("plain", plain)
    assert checked.where("_rn <> plain").count() == 0
    assert checked.count() == 2 * sum(DAYS)


@pytest.mark.parametrize("block", [1, 7, 100, 8192])
def test_blocks_equal_plain_window(spark, block):
    df = to_spark(spark, series([30, 2, 55], 0.2))

    def build(w):
        return {
            "avg5": F.avg("x").over(w.rowsBetween(-4, 0)),
            "lag3": F.lag("x", 3).over(w),
        }

    def chained(w):
        return {"lag_of_lag": F.lag("lag3").over(w)}

    blocked = row_features(df, [RowFeature(4, build), RowFeature(1, chained)], "minute", block=block)
    w = Window.partitionBy("symbol").orderBy("bar_ts")
    plain = df.withColumns(build(w)).withColumns(chained(w))
    a, b = ordered(blocked), ordered(plain)
    pd.testing.assert_frame_equal(a[b.columns.tolist()], b)


def test_running_counts_match_pandas(spark):
    pdf = series(DAYS)
    pdf["y"] = (pdf["y"] > 17).astype(float)
    df = to_spark(spark, pdf).withColumn("flag", F.col("y") == 1)
    got = ordered(scan.running_counts(df, {"flag": ("n", "since")}, "minute"))
    for _, want in pdf.groupby("symbol"):
        flag = want["y"] == 1
        mine = got.loc[want.index]
        assert (mine["n"] == flag.cumsum()).all()
        since = flag.groupby(flag.cumsum()).cumcount()
        assert (mine["since"] == since).all()


@pytest.mark.parametrize("block", [1, 50, 8192])
def test_rolling_means_match_pandas(spark, block):
    pdf = series([30, 2, 55, 700], 0.2)
    means = [Mean("x", 5, "a"), Mean("y", 20, "b"), Mean("x", 7, "c", min_periods=1)]
    got = ordered(row_features(to_spark(spark, pdf), [], "minute", means, block=block))
    for _, want in pdf.groupby("symbol"):
        mine = got.loc[want.index]
        np.testing.assert_allclose(mine["a"], want["x"].rolling(5).mean(), rtol=1e-12)
        np.testing.assert_allclose(mine["b"], want["y"].rolling(20).mean(), rtol=1e-12)
        np.testing.assert_allclose(mine["c"], want["x"].rolling(7, min_periods=1).mean(), rtol=1e-12)
