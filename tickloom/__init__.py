"""Market-style time-series bars on Spark: load, fill, resample, indicators, labels, evaluation."""
