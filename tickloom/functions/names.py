"""Dataset-name and path grammar: ``stock_bars_{n}{unit}[_{base|diff}_{features}]``."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a duration token is digits followed by letters.
DURATION_PATTERN = r"^(\d+)([a-zA-Z]+)$"
# Fixed value: names with at least this many tokens carry the base/diff and feature-type parts.
LONG_NAME_TOKENS = 5


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def dataset_name(path: Column) -> Column:
    """File name up to its first dot."""
    return F.substring_index(file_name(path), ".", 1)


def file_extension(path: Column) -> Column:
    return F.split_part(file_name(path), F.lit("."), F.lit(2))


def _token(name: Column, from_end: int) -> Column:
    return F.try_element_at(F.split(name, "_"), F.lit(-from_end))


def name_parts(name: Column) -> dict[str, Column]:
    """Columns ``features_type, base_or_diff, duration, duration_unit`` parsed from a dataset name."""
    is_long = F.size(F.split(name, "_")) >= LONG_NAME_TOKENS
    duration = F.when(is_long, _token(name, 3)).otherwise(_token(name, 1))
    digits = F.regexp_extract(duration, DURATION_PATTERN, 1)
    return {
        "features_type": F.when(is_long, _token(name, 1)),
        "base_or_diff": F.when(is_long, _token(name, 2)),
        "duration": F.when(digits != "", digits.cast("int")),
        "duration_unit": F.when(digits != "", F.regexp_extract(duration, DURATION_PATTERN, 2)),
    }


def time_period(name: Column) -> Column:
    """Catalog time period, e.g. '30min' of 'stock_bars_30min_base_avg'."""
    return F.split_part(F.replace(name, F.lit("stock_bars_"), F.lit("")), F.lit("_"), F.lit(1))


def split_duration(duration: str) -> tuple[int, str]:
    """'30min' -> (30, 'min'); '2D' -> (2, 'D')."""
    match = re.match(DURATION_PATTERN, duration)
    if match is None:
        raise ValueError(f"not a duration: {duration!r}")
    return int(match.group(1)), match.group(2)


def columns_with(columns: list[str], *parts: str) -> list[str]:
    """Columns whose name contains any of the parts."""
    return [c for c in columns if any(p in c for p in parts)]


def columns_without(columns: list[str], *parts: str) -> list[str]:
    return [c for c in columns if not any(p in c for p in parts)]


def by_first_number(columns: list[str]) -> list[str]:
    """Column names ordered by the first integer they contain."""
    return sorted(columns, key=lambda c: int(re.search(r"\d+", c).group()))
