"""Loaders and SQL fragments shared by the registered queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators import prep
from tickloom.sources import bars as bar_sources
from tickloom.sources.bars import table

__all__ = ["table", "minute", "hour", "day", "filled", "rounded", "register", "BARS", "HOURS", "DAYS", "FILLED"]


def minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bar_sources.minute_bars(table(spark, sf_dir, "events"))


def hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bar_sources.hour_bars(table(spark, sf_dir, "events"))


def day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bar_sources.day_bars(table(spark, sf_dir, "orders"))


def filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prep.with_market_open(prep.fill_minutes(minute(spark, sf_dir)))


# Halves are rounded up.
HALF = 0.5
# For means of a few decimals: true halves are common there, and the order of additions decides whether one comes out a
# last bit below; these are rounded up too.
MEAN_HALF = 0.5003


def rnd(column, digits: int) -> Column:
    """Rounds a double; the SQL side uses the same arithmetic."""
    scale = float(10**digits)
    c = F.col(column) if isinstance(column, str) else column
    return F.floor(c * scale + HALF) / scale


def rounded(df: DataFrame, digits: int = 6, columns: list[str] | None = None, half: float = HALF) -> DataFrame:
    """Rounds the double columns, so that engines that add in another order agree."""
    names = columns or [n for n, t in df.dtypes if t == "double"]
    scale = f"{10**digits}D"
    return df.selectExpr(
        *[
            f"floor(`{c}` * {scale} + {half}D) / {scale} AS `{c}`" if c in names else f"`{c}`"
            for c in df.columns
        ]
    )


def _expand_round(sql: str, half: float) -> str:
    """Writes every ``round(x, n)`` of a query as the arithmetic of :func:`rnd`."""
    out, at = [], 0
    while (start := sql.find("round(", at)) >= 0:
        depth, comma, i = 1, -1, start + len("round(")
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[i], 0)
            if sql[i] == "," and depth == 1:
                comma = i
            i += 1
        body = _expand_round(sql[start + len("round(") : comma], half)
        scale = f"1e{int(sql[comma + 1 : i - 1])}"
        out += [sql[at:start], f"(floor(({body}) * {scale} + {half}) / {scale})"]
        at = i
    return "".join(out) + sql[at:]


def register(into: dict, sql: str | None = None, half: float = HALF):
    expanded = None if sql is None else _expand_round(sql, half)

    def add(fn):
        into[fn.__name__] = (fn, expanded)
        return fn

    return add


def round_sql(columns: list[str], digits: int = 6) -> str:
    return ", ".join(f"round({c}, {digits}) AS {c}" for c in columns)


def _event_bars(name: str, unit: str) -> str:
    return f"""{name} AS MATERIALIZED (
  SELECT event_type AS symbol, date_trunc('{unit}', ts) AS bar_ts,
    first(value ORDER BY ts, event_id) AS open, max(value) AS high, min(value) AS low,
    last(value ORDER BY ts, event_id) AS close, CAST(sum(k) AS DOUBLE) AS volume,
    CAST(count(*) AS DOUBLE) AS trade_count, sum(value * k) / nullif(sum(k), 0) AS vwap
  FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k FROM events)
  GROUP BY 1, 2)"""


BARS = _event_bars("bars", "minute")
HOURS = _event_bars("hours", "hour")
DAYS = """days AS MATERIALIZED (
  SELECT o_orderpriority AS symbol, o_orderdate AS bar_ts,
    first(o_totalprice ORDER BY o_orderkey) AS open, max(o_totalprice) AS high,
    min(o_totalprice) AS low, last(o_totalprice ORDER BY o_orderkey) AS close,
    sum(o_totalprice) AS volume, CAST(count(*) AS DOUBLE) AS trade_count
  FROM orders GROUP BY 1, 2)"""
MARKET = "(hour(bar_ts) * 60 + minute(bar_ts) BETWEEN 570 AND 959)"
FILLED = f"""{BARS}, grid AS (
  SELECT symbol, unnest(generate_series(lo, hi, INTERVAL 1 MINUTE)) AS t
  FROM (SELECT symbol, CAST(bar_ts AS DATE) AS d, min(bar_ts) AS lo, max(bar_ts) AS hi
        FROM bars GROUP BY 1, 2)),
filled AS MATERIALIZED (
  SELECT grid.symbol, grid.t AS bar_ts, open, high, low, close, volume, trade_count,
    coalesce(vwap, close) AS vwap,
    (hour(grid.t) * 60 + minute(grid.t) BETWEEN 570 AND 959) AS market_open
  FROM grid ASOF JOIN bars ON grid.symbol = bars.symbol AND grid.t >= bars.bar_ts)"""
W = "(PARTITION BY symbol ORDER BY bar_ts)"
