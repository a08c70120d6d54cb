"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR: folder of the tables; BENCH_CPUS: local threads. Results go to a sink that reads
every value and keeps nothing, so the time is Spark's own.
"""

from __future__ import annotations

import json
import os
import re
import time

from pyspark.sql import SparkSession

from tickloom import suite
from tickloom.session import tuned
from tickloom.suite.indicators import filled_ema

HEADLINES = [
    "S9_minute_bars",
    "J4_fill_minutes",
    "A1_J1_resample_30min",
    "A1_S11_all_minute_durations",
    "A3_resample_30days",
    "W1_first_differences",
    "W3_simple_averages",
    "W4_exponential_averages",
    "W5_moving_average_sweep",
    "W6_rsi",
    "W7_rsi_sweep",
    "W9_timeframe_rsi_sweep",
    "W12_macd_sweep",
    "W13_lags",
    "W19_W20_extrema_counts",
    "W13_W22_custom_features",
    "W25_W26_reversal_labels",
    "bars_to_class_counts",
    "A11_correlation_matrix",
    "A18_classification_report",
    "M1_J2_J3_training_table",
    "M2_walk_forward_splits",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        tuned(SparkSession.builder.master(f"local[{cpus}]"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = dict(suite.queries(), filled_moving_averages=filled_ema)
    names = [n for n in HEADLINES if n in registered] + ["filled_moving_averages"]

    def run(name: str) -> float:
        start = time.perf_counter()
        registered[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run("bars_to_class_counts")  # warm-up
    times = {name: round(run(name), 3) for name in names}
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
