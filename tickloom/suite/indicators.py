"""Differences, moving averages, RSI and MACD."""

from __future__ import annotations

from tickloom.operators import indicators as ind
from tickloom.operators import prep
from tickloom.sources import storage
from tickloom.suite.common import BARS, DAYS, MEAN_HALF, W, day, filled, minute, register, round_sql, rounded

QUERIES: dict = {}
FIELDS = ["open", "high", "low", "close", "volume", "trade_count", "vwap"]
KEYS = "symbol, bar_ts"


def _sma(field: str, n: int) -> str:
    frame = f"OVER (PARTITION BY symbol ORDER BY bar_ts ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count({field}) {frame} = {n} THEN avg({field}) {frame} END"


def _numbered(source: str, columns: list[str], name: str = "s") -> str:
    return f"""{name} AS MATERIALIZED (SELECT symbol, bar_ts, {', '.join(columns)},
      row_number() OVER {W} AS rn FROM {source})"""


def _ewm_step(value: str, alpha: str, y: str, w: str) -> str:
    """One unadjusted step; the weight of the old average keeps decaying over null rows."""
    old = f"{w} * (1 - {alpha})"
    return (
        f"CASE WHEN {value} IS NULL THEN {y} WHEN {y} IS NULL THEN {value} "
        f"ELSE ({old} * {y} + {alpha} * {value}) / ({old} + {alpha}) END"
    )


def _ewm_recursion(name: str, source: str, specs: list[tuple[str, str, str]]) -> str:
    """Recursive CTE of null-aware averages; specs are (value column, alpha, output)."""
    first = ", ".join(f"{v} AS {o}, 1.0::DOUBLE AS w_{o}" for v, _, o in specs)
    step = ", ".join(
        f"{_ewm_step('s.' + v, a, 'p.' + o, 'p.w_' + o)} AS {o}, "
        f"CASE WHEN s.{v} IS NULL THEN p.w_{o} * (1 - {a}) ELSE 1.0 END AS w_{o}"
        for v, a, o in specs
    )
    return f"""{name} AS (SELECT symbol, rn, bar_ts, {first} FROM {source} WHERE rn = 1
      UNION ALL SELECT s.symbol, s.rn, s.bar_ts, {step}
      FROM {name} p JOIN {source} s ON s.symbol = p.symbol AND s.rn = p.rn + 1)"""


def _alpha(span: int) -> str:
    return f"(2.0::DOUBLE / {span + 1})"


@register(
    QUERIES,
    f"WITH {BARS} SELECT {KEYS}, "
    + ", ".join(f"round({f} - lag({f}) OVER {W}, 6) AS {f}_diff" for f in FIELDS)
    + " FROM bars",
)
def W1_first_differences(spark, sf):
    b = minute(spark, sf)
    out = ind.difference(b, "minute")
    return rounded(out.select("symbol", "bar_ts", *[f"{f}_diff" for f in FIELDS]))


@register(
    QUERIES,
    f"""WITH {BARS} SELECT {KEYS}, CAST(date_diff('second', lag(bar_ts) OVER {W}, bar_ts) AS DOUBLE) AS time_delta
    FROM bars""",
)
def W2_time_gaps(spark, sf):
    return ind.time_gaps(minute(spark, sf), "minute").select("symbol", "bar_ts", "time_delta")


@register(
    QUERIES,
    f"WITH {BARS} SELECT {KEYS}, "
    + ", ".join(
        f"round({_sma(f, n)}, 6) AS {f}_sma_{n}m" for n in ind.AVG_WINDOWS_MINUTES for f in ("close", "vwap")
    )
    + " FROM bars",
    MEAN_HALF,
)
def W3_simple_averages(spark, sf):
    b = minute(spark, sf).select("symbol", "bar_ts", "close", "vwap")
    return rounded(ind.simple_averages(b, ["close", "vwap"], ind.AVG_WINDOWS_MINUTES, "minute").drop("close", "vwap"), half=MEAN_HALF)


_EMA = [("close", _alpha(n), f"close_ema_{n}m") for n in ind.AVG_WINDOWS_MINUTES]


@register(
    QUERIES,
    f"WITH RECURSIVE {BARS}, {_numbered('bars', ['close'])}, {_ewm_recursion('e', 's', _EMA)} "
    f"SELECT {KEYS}, {round_sql([o for _, _, o in _EMA])} FROM e",
)
def W4_exponential_averages(spark, sf):
    b = minute(spark, sf).select("symbol", "bar_ts", "close")
    return rounded(ind.exponential_averages(b, ["close"], ind.AVG_WINDOWS_MINUTES, "minute").drop("close"))


_GAP_WINDOWS = [2, 5, 26, 200]
_GAP_EMA = [("close", _alpha(n), f"close_ema_{n}m") for n in _GAP_WINDOWS]


@register(
    QUERIES,
    f"""WITH RECURSIVE {DAYS}, org AS (SELECT symbol, min(bar_ts) AS lo, max(bar_ts) AS hi FROM days GROUP BY 1),
    grid AS (SELECT symbol, unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS bar_ts FROM org),
    dense AS (SELECT grid.symbol, grid.bar_ts, days.close FROM grid
      LEFT JOIN days ON days.symbol = grid.symbol AND days.bar_ts = grid.bar_ts),
    {_numbered('dense', ['close'])}, {_ewm_recursion('e', 's', _GAP_EMA)}
    SELECT {KEYS}, {round_sql([o for _, _, o in _GAP_EMA], 3)} FROM e""",
)
def W4_exponential_averages_with_gaps(spark, sf):
    """Daily bars on a full calendar: days without a bar are null and keep the weight decaying."""
    b = prep.resample_days(day(spark, sf), 1).select("symbol", "bar_ts", "close")
    return rounded(ind.exponential_averages(b, ["close"], _GAP_WINDOWS, "day").drop("close"), 3)


_SWEEP = [(f, _alpha(n), f"{f}_ema_{n}m") for n in ind.AVG_WINDOWS_MINUTES for f in FIELDS]


@register(
    QUERIES,
    f"WITH RECURSIVE {BARS}, {_numbered('bars', FIELDS)}, {_ewm_recursion('e', 's', _SWEEP)} "
    f"SELECT e.symbol, e.bar_ts, "
    + ", ".join(f"round(e.{o}, 6) AS {o}" for _, _, o in _SWEEP)
    + ", "
    + ", ".join(f"round(m.{f}_sma_{n}m, 6) AS {f}_sma_{n}m" for n in ind.AVG_WINDOWS_MINUTES for f in FIELDS)
    + " FROM e JOIN (SELECT symbol, bar_ts, "
    + ", ".join(f"{_sma(f, n)} AS {f}_sma_{n}m" for n in ind.AVG_WINDOWS_MINUTES for f in FIELDS)
    + " FROM bars) m ON m.symbol = e.symbol AND m.bar_ts = e.bar_ts",
    MEAN_HALF,
)
def W5_moving_average_sweep(spark, sf):
    out = ind.moving_averages(storage.stage(minute(spark, sf)), FIELDS, ind.avg_windows(1, "min"), "minute")
    return rounded(out.drop(*FIELDS), half=MEAN_HALF)


def _rsi_ctes(fields: list[str], windows: list[int], source: str) -> str:
    moves = ", ".join(
        f"coalesce(greatest({f} - lag({f}) OVER {W}, 0), 0) AS g{i}, "
        f"coalesce(greatest(lag({f}) OVER {W} - {f}, 0), 0) AS l{i}"
        for i, f in enumerate(fields)
    )
    moved = f"""moved AS MATERIALIZED (SELECT symbol, bar_ts, row_number() OVER {W} AS rn, {moves} FROM {source})"""
    specs = [(f"{s}{i}", f"(1.0::DOUBLE / {n})", f"{s}{i}_{n}") for i in range(len(fields)) for n in windows for s in "gl"]
    return moved + ", " + _ewm_recursion("r", "moved", specs)


def _rsi_value(g: str, l: str) -> str:
    return f"CASE WHEN {l} = 0 THEN CASE WHEN {g} > 0 THEN 100.0 END ELSE 100 - 100 / (1 + {g} / {l}) END"


def _rsi_columns(fields: list[str], windows: list[int]) -> str:
    return ", ".join(
        f"CASE WHEN rn >= {n} THEN round({_rsi_value(f'g{i}_{n}', f'l{i}_{n}')}, 6) END AS {f}_{n}window_rsi"
        for i, f in enumerate(fields)
        for n in windows
    )


@register(
    QUERIES,
    f"WITH RECURSIVE {BARS}, {_rsi_ctes(['close'], [14], 'bars')} SELECT {KEYS}, {_rsi_columns(['close'], [14])} FROM r",
)
def W6_rsi(spark, sf):
    b = minute(spark, sf).select("symbol", "bar_ts", "close")
    return rounded(ind.rsi(b, ["close"], [14], "minute").drop("close"))


_RSI_WINDOWS, _RSI_FIELDS = ind.rsi_plan(1, "min")


@register(
    QUERIES,
    f"WITH RECURSIVE {BARS}, {_numbered('bars', ['close'])}, "
    + _ewm_recursion("e", "s", [("close", _alpha(2), "close_ema_2m")])
    + f", src AS MATERIALIZED (SELECT b.symbol, b.bar_ts, b.close, e.close_ema_2m, {_sma('close', 2)} AS close_sma_2m"
    + " FROM bars b JOIN e USING (symbol, bar_ts)), "
    + _rsi_ctes(_RSI_FIELDS, _RSI_WINDOWS, "src")
    + f" SELECT {KEYS}, {_rsi_columns(_RSI_FIELDS, _RSI_WINDOWS)} FROM r",
)
def W7_rsi_sweep(spark, sf):
    b = minute(spark, sf).select("symbol", "bar_ts", "close")
    b = storage.stage(ind.moving_averages(storage.stage(b), ["close"], [2], "minute"))
    return rounded(ind.rsi(b, _RSI_FIELDS, _RSI_WINDOWS, "minute").drop(*_RSI_FIELDS))


def _simple_rsi_sql(windows: list[int], timeframes: list[int], source: str, cte: str) -> str:
    def frame(n):
        return f"OVER (PARTITION BY symbol ORDER BY bar_ts ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"

    last = ", ".join(
        f"CASE WHEN row_number() OVER {W} >= {n} THEN close END AS c{n}" for n in timeframes
    )
    moves = ", ".join(
        f"coalesce(greatest(c{n} - lag(c{n}) OVER {W}, 0), 0) AS gp{n}, "
        f"coalesce(greatest(lag(c{n}) OVER {W} - c{n}, 0), 0) AS lp{n}, "
        f"coalesce(greatest(c{n} - open, 0), 0) AS go{n}, coalesce(greatest(open - c{n}, 0), 0) AS lo{n}"
        for n in timeframes
    )
    means, outs = [], []
    for n in timeframes:
        for w in windows:
            for key, kind in (("p", "close_prev"), ("o", "close_open")):
                means.append(f"avg(g{key}{n}) {frame(w)} AS ag{key}{n}_{w}, avg(l{key}{n}) {frame(w)} AS al{key}{n}_{w}")
                outs.append(
                    f"round({_rsi_value(f'ag{key}{n}_{w}', f'al{key}{n}_{w}')}, 5) AS {kind}_rsi_{w}_{n}T"
                )
    return f"""WITH {cte}, a AS (SELECT symbol, bar_ts, open, close, {last} FROM {source}),
    m AS (SELECT symbol, bar_ts, {moves} FROM a), v AS (SELECT symbol, bar_ts, {', '.join(means)} FROM m)
    SELECT symbol, bar_ts, {', '.join(outs)} FROM v"""


@register(QUERIES, _simple_rsi_sql([9, 14], [1], "bars", BARS))
def W8_simple_average_rsi(spark, sf):
    b = minute(spark, sf).select("symbol", "bar_ts", "open", "close")
    out = ind.simple_rsi(b, [9, 14], "minute", [1])
    return rounded(out.drop("open", "close", "close_last_1T"), 5)


_FRAMES = ind.RSI_TIMEFRAMES


@register(QUERIES, _simple_rsi_sql(ind.RSI_SIMPLE_WINDOWS, _FRAMES, "bars", BARS), MEAN_HALF)
def W9_timeframe_rsi_sweep(spark, sf):
    b = minute(spark, sf).select("symbol", "bar_ts", "open", "close")
    out = ind.simple_rsi(b, ind.RSI_SIMPLE_WINDOWS, "minute", _FRAMES)
    return rounded(out.drop("open", "close", *[f"close_last_{n}T" for n in _FRAMES]), 5, half=MEAN_HALF)


def _macd_sql(windows: list[int], signals: list[int], extras: bool, digits: int) -> str:
    emas = [("close", _alpha(n), f"close_ema_{n}m") for n in windows]
    pairs = ind.macd_pairs([o for _, _, o in emas])
    lines = ", ".join(f"{a} - {b} AS MACD_{a}_{b}" for a, b in pairs)
    specs = [(f"MACD_{a}_{b}", _alpha(n), f"Signal_{a}_{b}_signal{n}") for n in signals for a, b in pairs]
    out = [f"round(g.{o}, {digits}) AS {o}" for _, _, o in specs]
    if extras:
        out += [f"round(x.MACD_{a}_{b}, {digits}) AS MACD_{a}_{b}" for a, b in pairs]
        out += [
            f"round(x.MACD_{a}_{b} - g.Signal_{a}_{b}_signal{n}, {digits}) AS Histogram_{a}_{b}_signal{n}"
            for n in signals
            for a, b in pairs
        ]
    return f"""WITH RECURSIVE {BARS}, {_numbered('bars', ['close'])}, {_ewm_recursion('e', 's', emas)},
    x AS MATERIALIZED (SELECT symbol, bar_ts, rn, {lines} FROM e), {_ewm_recursion('g', 'x', specs)}
    SELECT g.symbol, g.bar_ts, {', '.join(out)} FROM g JOIN x ON x.symbol = g.symbol AND x.rn = g.rn"""


@register(QUERIES, _macd_sql([12, 26], [14], True, 6))
def W10_W11_macd(spark, sf):
    b = minute(spark, sf).select("symbol", "bar_ts", "close")
    b = storage.stage(ind.exponential_averages(b, ["close"], [12, 26], "minute"))
    emas = ["close_ema_12m", "close_ema_26m"]
    return rounded(ind.macd(b, emas, [14], "minute", lines=True, histograms=True).drop("close", *emas))


@register(QUERIES, _macd_sql(ind.AVG_WINDOWS_MINUTES, ind.MACD_SIGNALS_SHORT, False, 5))
def W12_macd_sweep(spark, sf):
    """28 EMA pairs times 5 signals."""
    b = minute(spark, sf).select("symbol", "bar_ts", "close")
    b = storage.stage(ind.exponential_averages(b, ["close"], ind.AVG_WINDOWS_MINUTES, "minute"))
    emas = [f"close_ema_{n}m" for n in ind.AVG_WINDOWS_MINUTES]
    return rounded(ind.macd(b, emas, ind.macd_signals(1, "min"), "minute").drop("close", *emas), 5)


@register(
    QUERIES,
    f"""WITH {DAYS}, y AS (SELECT symbol, bar_ts, close, year(bar_ts) AS yr, FALSE AS warm FROM days
      UNION ALL SELECT symbol, bar_ts, close, year(bar_ts) + 1, TRUE FROM days
      WHERE month(bar_ts) = 12 AND day(bar_ts) >= 29),
    a AS (SELECT *, count(close) OVER f AS n, avg(close) OVER f AS m FROM y
      WINDOW f AS (PARTITION BY symbol, yr ORDER BY bar_ts ROWS BETWEEN 2 PRECEDING AND CURRENT ROW))
    SELECT symbol, bar_ts, CAST(yr AS INTEGER) AS year, CASE WHEN n = 3 THEN round(m, 4) END AS close_sma_3m
    FROM a WHERE NOT warm""",
)
def W30_yearly_chunks(spark, sf):
    b = day(spark, sf).select("symbol", "bar_ts", "close")
    return rounded(ind.yearly_averages(b, ["close"], [3]).drop("close"), 4)


def filled_ema(spark, sf):
    """Used by the benchmark: averages over the minute-filled series."""
    b = storage.stage(filled(spark, sf).select("symbol", "bar_ts", "close", "volume"))
    return ind.moving_averages(b, ["close", "volume"], ind.AVG_WINDOWS_MINUTES, "minute")
