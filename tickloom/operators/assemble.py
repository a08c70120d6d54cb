"""Wide training tables from keyed feature and label tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEYS = ["symbol", "bar_ts"]
# Columns that look into the future; they would leak the label into training.
FUTURE_COLUMNS = ["future_highs", "future_lows"]


def key_report(left: DataFrame, right: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """One row: rows on each side, and keys that the other side lacks. One shuffle for both sides."""
    marked = left.select(*keys, F.lit(1).alias("_l"), F.lit(0).alias("_r")).unionByName(
        right.select(*keys, F.lit(0).alias("_l"), F.lit(1).alias("_r"))
    )
    counts = marked.groupBy(*keys).agg(F.sum("_l").alias("_l"), F.sum("_r").alias("_r"))
    return counts.agg(
        F.coalesce(F.sum("_l"), F.lit(0)).alias("left_rows"),
        F.coalesce(F.sum("_r"), F.lit(0)).alias("right_rows"),
        F.count_if(F.col("_r") == 0).alias("missing_right"),
        F.count_if(F.col("_l") == 0).alias("missing_left"),
    )


def same_keys(left: DataFrame, right: DataFrame, keys: list[str] = KEYS) -> bool:
    report = key_report(left, right, keys).first()
    return (
        report["left_rows"] == report["right_rows"]
        and report["missing_left"] == 0
        and report["missing_right"] == 0
    )


def join_new_columns(base: DataFrame, other: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Left join that takes only the columns ``base`` does not have yet."""
    fresh = [c for c in other.columns if c not in base.columns]
    return base.join(other.select(*keys, *fresh), keys, "left")


def drop_text_columns(df: DataFrame, keep: list[str] = ()) -> DataFrame:
    text = [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.StringType) and f.name not in keep
    ]
    return df.drop(*text)


def training_table(
    base: DataFrame,
    features: dict[str, DataFrame],
    labels: DataFrame,
    keep_future: bool = False,
    check: bool = True,
) -> tuple[DataFrame, list[str]]:
    """Joins the feature tables and the labels to the base; returns the table and what was used.

    A feature table whose keys differ from the base is left out; labels whose keys differ are an
    error. Text columns other than the symbol are dropped, and so are future-looking measures
    unless ``keep_future`` is set. All joins share the keys, so the base is shuffled once.
    """
    out, used = base, []
    for name, table in features.items():
        if check and not same_keys(base, table):
            continue
        out = join_new_columns(out, table)
        used.append(name)
    if check and not same_keys(base, labels):
        raise ValueError("labels and base differ in their keys")
    out = join_new_columns(out, labels if keep_future else labels.drop(*FUTURE_COLUMNS))
    return drop_text_columns(out, keep=["symbol"]), used


def align_column(target: DataFrame, source: DataFrame, column: str, keys: list[str] = KEYS) -> DataFrame:
    """Takes one column from another table by key."""
    return target.drop(column).join(source.select(*keys, column), keys, "left")
