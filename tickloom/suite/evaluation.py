"""Correlations, classifier metrics, walk-forward splits, assembly and models."""

from __future__ import annotations

import functools

import numpy as np
from pyspark.sql import functions as F

from tickloom.operators import assemble, boosting, evaluate, fold_forest, prep
from tickloom.operators import indicators as ind
from tickloom.operators import labels as lab
from tickloom.operators import training as tr
from tickloom.plans import batch, incremental
from tickloom.plans.batch import Batch
from tickloom.sources import storage
from tickloom.suite.common import BARS, FILLED, MARKET, W, minute, register, rounded, table, rnd
from tickloom.suite.indicators import _alpha, _ewm_recursion, _numbered, _rsi_columns, _rsi_ctes
from tickloom.suite.labels import SMA5, SMA_TREND, _reversal, _sma, averaged, reversal, sma_trend

QUERIES: dict = {}
NUMERIC = ["open", "high", "low", "close", "volume", "trade_count", "vwap"]
CODE = "CASE {c} WHEN 'A' THEN 0 WHEN 'B' THEN 1 ELSE 2 END"
PRED = f"""{BARS}, {SMA5}, {_reversal('sma')}, {SMA_TREND},
pred AS MATERIALIZED (SELECT lab.symbol, lab.bar_ts, {CODE.format(c='lab.category')} AS actual,
  {CODE.format(c='trend.category')} AS pred FROM lab JOIN trend ON trend.symbol = lab.symbol AND trend.bar_ts = lab.bar_ts)"""
CLASS = """cls AS (SELECT * FROM (SELECT c AS label, count(*) FILTER (actual = c AND pred = c) AS hits,
  count(*) FILTER (pred = c) AS predicted, count(*) FILTER (actual = c) AS support
  FROM pred, (VALUES (0), (1), (2)) v(c) GROUP BY c) WHERE predicted + support > 0),
scored AS (SELECT *, coalesce(hits / nullif(predicted, 0), 0) AS "precision",
  coalesce(hits / nullif(support, 0), 0) AS recall, coalesce(2 * hits / nullif(predicted + support, 0), 0) AS f1 FROM cls)"""
CLASSES = [0, 1, 2]


def predictions(spark, sf):
    """Production labels as the truth, moving-average trend labels as the prediction."""
    actual = reversal(spark, sf).select("symbol", "bar_ts", F.col("mapped_category").alias("actual"))
    pred = sma_trend(spark, sf).select("symbol", "bar_ts", lab.code_of(F.col("category")).alias("pred"))
    return actual.join(pred, ["symbol", "bar_ts"])


def probabilities(spark, sf):
    """Three class scores that sum to 1, and an actual class, per line item."""
    p0, p1 = F.col("l_discount") * 5, F.col("l_tax") * 5
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        rnd(p0, 4).alias("p0"), rnd(p1, 4).alias("p1"), rnd(1 - p0 - p1, 4).alias("p2"),
        F.create_map(*[F.lit(x) for x in ("A", 0, "N", 1, "R", 2)])[F.col("l_returnflag")].alias("actual"),
        F.when(F.col("l_linestatus") == "F", "train").otherwise("test").alias("eval_set"),
    )


PROBS = """probs AS (SELECT l_orderkey, l_linenumber, l_partkey, round(l_discount * 5, 4) AS p0, round(l_tax * 5, 4) AS p1,
  round(1 - l_discount * 5 - l_tax * 5, 4) AS p2,
  CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 WHEN 'R' THEN 2 END AS actual,
  CASE l_linestatus WHEN 'F' THEN 'train' ELSE 'test' END AS eval_set FROM lineitem)"""


# -- correlation ----------------------------------------------------------------------------


def _corr(a: str, b: str) -> str:
    return f"CASE WHEN isnan(corr({a}, {b})) THEN NULL ELSE corr({a}, {b}) END"


@register(
    QUERIES,
    f"WITH {BARS} "
    + " UNION ALL ".join(
        f"SELECT symbol, '{a}' AS from_col, '{b}' AS to_col, round({_corr(a, b)}, 6) AS correlation FROM bars "
        f"WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY 1"
        for a in NUMERIC
        for b in NUMERIC
    ),
)
def A11_correlation_matrix(spark, sf):
    return rounded(evaluate.correlations(minute(spark, sf), NUMERIC))


#: Simple averages of the prices, in the lengths of the 1-minute sweep.
_WIDE_AVERAGES = [(f, n) for f in ("open", "high", "low", "close") for n in ind.avg_windows(1, "min")]
_WIDE_COLUMNS = ", ".join(f"{_sma(f, n)} AS {f}_sma_{n}m" for f, n in _WIDE_AVERAGES)


@register(
    QUERIES,
    f"""WITH {BARS}, wide AS MATERIALIZED (SELECT symbol, bar_ts, {_WIDE_COLUMNS} FROM bars),
    long AS MATERIALIZED (UNPIVOT wide ON COLUMNS(* EXCLUDE (symbol, bar_ts)) INTO NAME col VALUE v)
    SELECT a.symbol, a.col AS from_col, b.col AS to_col, round(CASE WHEN stddev_pop(a.v) > 1e-9 AND stddev_pop(b.v) > 1e-9 THEN corr(a.v, b.v) END, 6) AS correlation
    FROM long a JOIN long b ON a.symbol = b.symbol AND a.bar_ts = b.bar_ts AND a.col < b.col GROUP BY 1, 2, 3""",
)
def A11_W5_wide_correlations(spark, sf):
    """Correlations of all pairs of the sweep's simple averages, by symbol."""
    fields = list(dict.fromkeys(f for f, _ in _WIDE_AVERAGES))
    bars = minute(spark, sf).select("symbol", "bar_ts", *fields)
    table = storage.stage(ind.simple_averages(bars, fields, ind.avg_windows(1, "min"), "minute").drop(*fields), "averages")
    names = [c for c in table.columns if c not in ("symbol", "bar_ts")]
    return rounded(evaluate.correlations(table, names).where("from_col < to_col"))


RANKED = "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{a}' AS from_col, '{b}' AS to_col, {_corr(a, b)} AS correlation FROM bars WHERE {MARKET}"
    for a in NUMERIC
    for b in NUMERIC
    if a < b
) + ")"


@register(
    QUERIES,
    f"WITH {BARS} SELECT from_col, to_col, round(correlation, 6) AS correlation FROM ({RANKED}) WHERE correlation IS NULL OR correlation < 1 - 1e-12 ORDER BY 3 DESC, 1, 2",
)
def A12_ranked_pairs(spark, sf):
    b = prep.with_market_open(minute(spark, sf)).where("market_open")
    return rounded(evaluate.ranked_pairs(evaluate.correlations(b, NUMERIC, by=[])))


_ORDER = list(reversed(NUMERIC))
_PAIRS = [(a, b) for i, a in enumerate(_ORDER) for b in _ORDER[i + 1 :]]


@register(
    QUERIES,
    f"WITH RECURSIVE {BARS}, r AS MATERIALIZED ("
    + " UNION ALL ".join(
        f"SELECT {i + 1} AS step, '{a}' AS a, '{b}' AS b, coalesce(abs({_corr(a, b)}) > 0.95, FALSE) AS hit FROM bars"
        for i, (a, b) in enumerate(_PAIRS)
    )
    + f"""), g AS (SELECT 0 AS step, []::VARCHAR[] AS dropped UNION ALL
      SELECT g.step + 1, CASE WHEN r.hit AND NOT list_contains(dropped, r.a) AND NOT list_contains(dropped, r.b)
        THEN list_append(dropped, r.b) ELSE dropped END FROM g JOIN r ON r.step = g.step + 1)
    SELECT c AS "column" FROM (SELECT unnest({_ORDER}) AS c), g WHERE g.step = {len(_PAIRS)} AND NOT list_contains(g.dropped, c)""",
)
def A13_correlated_feature_pruning(spark, sf):
    kept = evaluate.uncorrelated_columns(minute(spark, sf), NUMERIC)
    return spark.createDataFrame([(c,) for c in kept], "column string")


@register(
    QUERIES,
    f"""WITH {BARS} SELECT symbol, round({_corr('volume', 'prev')}, 6) AS autocorrelation
    FROM (SELECT symbol, volume, lag(volume) OVER {W} AS prev FROM bars) GROUP BY 1""",
)
def A14_lag_autocorrelation(spark, sf):
    b = minute(spark, sf).select("symbol", "bar_ts", "volume")
    return rounded(evaluate.lag_correlation(b, "volume", "minute"))


# -- classifier metrics ---------------------------------------------------------------------


@register(
    QUERIES,
    f"WITH {PRED} SELECT actual, "
    + ", ".join(f"count(*) FILTER (pred = {c}) AS pred_{c}" for c in CLASSES)
    + " FROM pred GROUP BY 1",
)
def A15_confusion_matrix(spark, sf):
    return evaluate.confusion_matrix(predictions(spark, sf), CLASSES)


@register(
    QUERIES,
    f"""WITH {PRED}, {CLASS} SELECT round(sum(hits) / sum(support), 6) AS accuracy,
    round(avg(CASE WHEN support > 0 THEN recall END), 6) AS balanced_accuracy,
    round(sum(hits) / sum(predicted), 6) AS micro_precision, round(sum(hits) / sum(support), 6) AS micro_recall,
    round(2 * sum(hits) / (sum(predicted) + sum(support)), 6) AS micro_f1,
    """
    + ", ".join(
        f'round(avg("{m}"), 6) AS macro_{m}, round(sum("{m}" * support) / sum(support), 6) AS weighted_{m}'
        for m in ("precision", "recall", "f1")
    )
    + " FROM scored",
)
def A16_A17_M9_summary_scores(spark, sf):
    return rounded(evaluate.summary_scores(predictions(spark, sf), CLASSES))


@register(
    QUERIES,
    f"""WITH {PRED}, {CLASS} SELECT CAST(label AS VARCHAR) AS label, round("precision", 6) AS "precision",
      round(recall, 6) AS recall, round(f1, 6) AS f1, CAST(support AS BIGINT) AS support FROM scored
    UNION ALL SELECT 'accuracy', round(sum(hits) / sum(support), 6), round(sum(hits) / sum(support), 6),
      round(sum(hits) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM scored
    UNION ALL SELECT 'macro avg', round(avg("precision"), 6), round(avg(recall), 6), round(avg(f1), 6),
      CAST(sum(support) AS BIGINT) FROM scored
    UNION ALL SELECT 'weighted avg', round(sum("precision" * support) / sum(support), 6),
      round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6),
      CAST(sum(support) AS BIGINT) FROM scored""",
)
def A18_classification_report(spark, sf):
    return rounded(evaluate.classification_report(predictions(spark, sf), CLASSES))


@register(
    QUERIES,
    """WITH pred AS (SELECT quality AS actual, toxic AS pred FROM labels)
    SELECT actual, count(*) FILTER (pred = 0) AS pred_0, count(*) FILTER (pred = 1) AS pred_1 FROM pred GROUP BY 1""",
)
def A15_confusion_matrix_binary(spark, sf):
    pairs = table(spark, sf, "labels").select(F.col("quality").alias("actual"), F.col("toxic").alias("pred"))
    return evaluate.confusion_matrix(pairs, [0, 1])


BEST = "CASE WHEN p0 >= p1 AND p0 >= p2 THEN 0 WHEN p1 >= p2 THEN 1 ELSE 2 END"


@register(
    QUERIES,
    f"""WITH {PROBS}, s AS (SELECT eval_set, actual, {BEST} AS pred,
      CASE actual WHEN 0 THEN p0 WHEN 1 THEN p1 ELSE p2 END AS p FROM probs)
    SELECT eval_set, round(avg(CAST(pred <> actual AS INTEGER)), 6) AS merror,
      round(-avg(ln(greatest(p, 1e-15))), 6) AS mlogloss FROM s GROUP BY 1""",
)
def A19_evaluation_losses(spark, sf):
    p = probabilities(spark, sf).withColumn("pred", evaluate.argmax(["p0", "p1", "p2"]))
    return rounded(evaluate.losses(p, ["p0", "p1", "p2"]))


@register(
    QUERIES,
    f"""WITH {PROBS} SELECT l_orderkey, l_linenumber, l_partkey,
    CASE WHEN p0 > 0.3 THEN 'A' WHEN p1 > 0.3 THEN 'B' ELSE 'C' END AS category FROM probs""",
)
def P19_confident_category(spark, sf):
    decision = evaluate.confident_category({"A": "p0", "B": "p1", "C": "p2"}, 0.3)
    return probabilities(spark, sf).select("l_orderkey", "l_linenumber", "l_partkey", decision.alias("category"))


@register(
    QUERIES,
    f"""WITH {PROBS}, s AS (SELECT t AS threshold, actual,
      CASE WHEN p0 >= t THEN 0 WHEN p1 >= t THEN 1 WHEN p2 >= t THEN 2 ELSE 0 END AS pred
      FROM probs, (SELECT unnest([0.4, 0.5, 0.6, 0.7, 0.8, 0.9])::DOUBLE AS t))
    SELECT actual, threshold, count(*) FILTER (pred = 0) AS pred_0, count(*) FILTER (pred = 1) AS pred_1,
      count(*) FILTER (pred = 2) AS pred_2 FROM s GROUP BY 1, 2""",
)
def P20_threshold_argmax(spark, sf):
    thresholds = [i / 10 for i in range(4, 10)]
    return evaluate.threshold_confusion(probabilities(spark, sf), ["p0", "p1", "p2"], thresholds)


_SCORES = """scores AS (SELECT 'part_' || l_partkey AS feature, round(sum(l_extendedprice), 2) AS score FROM lineitem GROUP BY 1)"""


def _scores(spark, sf):
    return table(spark, sf, "lineitem").groupBy(
        F.concat(F.lit("part_"), "l_partkey").alias("feature")
    ).agg(rnd(F.sum("l_extendedprice"), 2).alias("score"))


@register(
    QUERIES,
    f"""WITH {_SCORES}, a AS (SELECT *, 'top' AS side FROM scores ORDER BY score DESC, feature LIMIT 40),
    b AS (SELECT *, 'bottom' AS side FROM scores ORDER BY score, feature LIMIT 40)
    SELECT * FROM a UNION ALL SELECT * FROM b""",
)
def T4_strongest_and_weakest(spark, sf):
    s = _scores(spark, sf)
    top = evaluate.strongest(s).withColumn("side", F.lit("top"))
    return top.unionByName(evaluate.weakest(s).withColumn("side", F.lit("bottom")))


@register(QUERIES, f"WITH {_SCORES} SELECT feature, score FROM scores ORDER BY score, feature")
def T5_sorted_importances(spark, sf):
    return _scores(spark, sf).orderBy("score", "feature")


# -- assembly -------------------------------------------------------------------------------


def base_table(spark, sf):
    return prep.with_market_open(averaged(spark, sf))


def feature_tables(spark, sf):
    close = storage.stage(minute(spark, sf).select("symbol", "bar_ts", "close"))
    return {
        "rsi": ind.rsi(close, ["close"], [14], "minute"),
        "diff": ind.difference(close, "minute"),
    }


@register(
    QUERIES,
    f"""WITH RECURSIVE {BARS}, {SMA5}, {_reversal('sma')}, {_rsi_ctes(['close'], [14], 'bars')}
    SELECT b.symbol, b.bar_ts, b.open, b.high, b.low, b.close, round(b.close_sma_5m, 6) AS close_sma_5m,
      (hour(b.bar_ts) * 60 + minute(b.bar_ts) BETWEEN 570 AND 959) AS market_open, x.close_14window_rsi,
      round(d.close_diff, 6) AS close_diff, round(l.slopes, 6) AS slopes,
      {CODE.format(c='l.category')} AS mapped_category
    FROM sma b JOIN (SELECT symbol, bar_ts, {_rsi_columns(['close'], [14])} FROM r) x
        ON x.symbol = b.symbol AND x.bar_ts = b.bar_ts
      JOIN (SELECT symbol, bar_ts, close - lag(close) OVER {W} AS close_diff FROM bars) d
        ON d.symbol = b.symbol AND d.bar_ts = b.bar_ts
      JOIN lab l ON l.symbol = b.symbol AND l.bar_ts = b.bar_ts""",
)
def M1_J2_J3_training_table(spark, sf):
    labelled = reversal(spark, sf).select(
        "symbol", "bar_ts", "category", "future_highs", "future_lows", "slopes", "mapped_category"
    )
    out, _ = assemble.training_table(base_table(spark, sf), feature_tables(spark, sf), labelled, check=False)
    return rounded(out)


@register(
    QUERIES,
    f"""WITH {BARS} SELECT count(*) AS left_rows, count(*) FILTER ({MARKET}) AS right_rows,
    count(*) FILTER (NOT {MARKET}) AS missing_right, CAST(0 AS BIGINT) AS missing_left FROM bars""",
)
def P18_key_guard(spark, sf):
    b = prep.with_market_open(minute(spark, sf))
    return assemble.key_report(b, b.where("market_open"))


@register(
    QUERIES,
    f"""WITH {BARS}, {SMA5}, {_reversal('sma')}
    SELECT symbol, bar_ts, category, {MARKET} AS market_open FROM lab""",
)
def J5_aligned_column(spark, sf):
    labels = reversal(spark, sf).select("symbol", "bar_ts", "category")
    bars = prep.with_market_open(minute(spark, sf))
    return assemble.align_column(labels, bars, "market_open")


# -- the whole run --------------------------------------------------------------------------

WEEK = "2024-01-22"
_FIVE = """five AS MATERIALIZED (SELECT symbol, bar_ts, open, high, low, close, volume FROM (
    SELECT symbol, time_bucket(INTERVAL '5 minutes', bar_ts) AS bar_ts, first(open ORDER BY bar_ts) AS open, max(high) AS high,
      min(low) AS low, last(close ORDER BY bar_ts) AS close, sum(volume) AS volume, min(bar_ts) AS edge FROM filled GROUP BY ALL) WHERE edge = bar_ts)"""
_REVISED = f"""raw AS MATERIALIZED (
    SELECT * REPLACE (CASE WHEN bar_ts >= TIMESTAMP '{WEEK}' THEN close + 0.25 ELSE close END AS close,
      CASE WHEN bar_ts >= TIMESTAMP '{WEEK}' THEN high + 0.25 ELSE high END AS high) FROM bars WHERE NOT (bar_ts >= TIMESTAMP '{WEEK}' AND symbol = 'signup'))"""
_FIVE_SMA = f"""sma AS MATERIALIZED (SELECT *, CASE WHEN count(close) OVER f = 5 THEN avg(close) OVER f END AS close_sma_5m FROM five
    WINDOW f AS (PARTITION BY symbol ORDER BY bar_ts ROWS BETWEEN 4 PRECEDING AND CURRENT ROW))"""
_SO_FAR = "(PARTITION BY symbol ORDER BY bar_ts ROWS UNBOUNDED PRECEDING)"
_TO_NOW = "(PARTITION BY symbol, CAST(bar_ts AS DATE) ORDER BY bar_ts ROWS UNBOUNDED PRECEDING)"
_PRIOR = "(PARTITION BY symbol ORDER BY bar_ts ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING)"


def _whole_run(raw: str, future: str = "") -> str:
    """SQL of the training table after a run over ``raw``; ``future`` names further columns."""
    return f"""WITH RECURSIVE {BARS}, {raw}, {FILLED.replace(BARS + ', ', '').replace('FROM bars', 'FROM raw').replace('JOIN bars ON', 'JOIN raw bars ON')},
    {_FIVE}, {_FIVE_SMA}, {_reversal('sma')}, {_rsi_ctes(['close'], [14], 'five')},
    {_numbered('five', ['close'])}, {_ewm_recursion('e', 's', [('close', _alpha(n), f'e{n}') for n in (2, 3, 5)])},
    lines AS MATERIALIZED (SELECT symbol, rn, bar_ts, e2 - e3 AS line FROM e), {_ewm_recursion('g', 'lines', [('line', _alpha(11), 'signal')])},
    moves AS (SELECT *, close - lag(close) OVER {W} AS move FROM five),
    custom AS (SELECT symbol, bar_ts, row_number() OVER {W} AS rn, lag(close, 15) OVER {W} AS close_lag_15,
      CAST(count(*) FILTER (move > 0) OVER {_TO_NOW} AS BIGINT) AS cumulative_ups,
      count(close) OVER {_PRIOR} = 30 AND close >= max(close) OVER {_PRIOR} AS top, max(high) OVER {_TO_NOW} AS max_today FROM moves),
    counted AS (SELECT *, CAST(count(*) FILTER (top) OVER {_SO_FAR} AS BIGINT) AS cumulative_local_max_30,
      rn - coalesce(max(CASE WHEN top THEN rn END) OVER {_SO_FAR}, 1) AS time_since_prev_max_30 FROM custom),
    finals AS (SELECT symbol, CAST(bar_ts AS DATE) AS d, count(*) FILTER (move < 0) AS downs FROM moves GROUP BY ALL),
    previous AS (SELECT symbol, d, lag(downs) OVER (PARTITION BY symbol ORDER BY d) AS prev_cumulative_downs FROM finals)
    SELECT l.symbol, l.bar_ts, l.open, round(l.high, 6) AS high, l.low, round(l.close, 6) AS close, l.volume, round(a.close_sma_5m, 6) AS close_sma_5m,
      round(e.e5, 6) AS close_ema_5m, round(g.signal, 6) AS signal_2_3_11, x.close_14window_rsi, round(c.close_lag_15, 6) AS close_lag_15,
      c.cumulative_ups, prev_cumulative_downs, cumulative_local_max_30, time_since_prev_max_30, round(max_today, 6) AS max_today,
      round(l.slopes, 6) AS slopes,{future} {CODE.format(c='l.category')} AS mapped_category
    FROM lab l JOIN sma a ON a.symbol = l.symbol AND a.bar_ts = l.bar_ts JOIN e ON e.symbol = l.symbol AND e.bar_ts = l.bar_ts JOIN g ON g.symbol = l.symbol AND g.bar_ts = l.bar_ts
      JOIN (SELECT symbol, bar_ts, {_rsi_columns(['close'], [14])} FROM r) x ON x.symbol = l.symbol AND x.bar_ts = l.bar_ts
      JOIN counted c ON c.symbol = l.symbol AND c.bar_ts = l.bar_ts
      JOIN previous p ON p.symbol = l.symbol AND p.d = CAST(l.bar_ts AS DATE)"""


_RUN_COLUMNS = [
    "symbol", "bar_ts", "open", "high", "low", "close", "volume", "close_sma_5m", "close_ema_5m", "signal_2_3_11", "close_14window_rsi", "close_lag_15",
    "cumulative_ups", "prev_cumulative_downs", "cumulative_local_max_30", "time_since_prev_max_30", "max_today", "slopes",
]


def _run_columns(table, *more):
    return rounded(table.withColumn("signal_2_3_11", F.col("Signal_close_ema_2m_close_ema_3m_signal11")).select(*_RUN_COLUMNS, *more, "mapped_category"))


@register(QUERIES, _whole_run("raw AS MATERIALIZED (SELECT * FROM bars)"))
def M1_P18_stored_training_table(spark, sf):
    """The whole run: the stored averages, RSI, signals, custom features and labels joined, with their keys checked and without future measures."""
    plan = Batch(root=storage.new_folder(spark, "run"), durations=["5min"], label_duration="5min", kinds=("base",))
    table = batch.run(spark, plan, {"minute": storage.stage(minute(spark, sf), "landed")}, "2024-01-01")
    left = [c for c in assemble.FUTURE_COLUMNS if c in table.columns]
    if left:
        raise ValueError(f"future measures in the training table: {left}")
    return _run_columns(table)


@register(QUERIES, _whole_run(_REVISED, " round(l.future_highs, 6) AS future_highs,"))
def M11_incremental_batch(spark, sf):
    """Two runs of the batch: all bars, then the last days with other prices and a series that ends; the training table after both.

    The second run carries the change through fill, resampling, averages, RSI, signals, custom features and labels from
    kept chunk summaries; the joined tables' keys are checked, and the future measures stay.
    """
    bars = storage.stage(minute(spark, sf), "landed")
    plan = Batch(root=storage.new_folder(spark, "batch"), durations=["5min"], label_duration="5min", kinds=("base",))
    incremental.update(spark, plan, {"minute": bars}, "2024-01-01", keep_future=True)
    raised = [(F.col(c) + 0.25).alias(c) if c in ("close", "high") else F.col(c) for c in bars.columns]
    revised = storage.trim(bars, WEEK).where("symbol <> 'signup'").select(*raised)
    table = incremental.update(spark, plan, {"minute": revised}, WEEK, keep_future=True)
    return _run_columns(table, "future_highs")


# -- walk-forward splits --------------------------------------------------------------------

FOLDS = tr.folds("2024-01-15", "2024-02-02")


@register(
    QUERIES,
    f"""WITH {BARS}, t AS (SELECT CAST(bar_ts AS DATE) AS d, {MARKET} AS mo FROM bars),
    f AS (SELECT CAST(unnest(generate_series(DATE '2024-01-15', DATE '2024-02-02', INTERVAL 1 DAY)) AS DATE) AS fd)
    SELECT CAST(fd AS VARCHAR) AS fold, 'train' AS split, count(*) FILTER (d < fd) AS rows FROM f, t GROUP BY 1
    UNION ALL SELECT CAST(fd AS VARCHAR), 'test_1_day', count(*) FILTER (mo AND d = fd) FROM f, t GROUP BY 1
    UNION ALL SELECT CAST(fd AS VARCHAR), 'test_10_day', count(*) FILTER (mo AND d BETWEEN fd AND fd + 9) FROM f, t GROUP BY 1
    UNION ALL SELECT CAST(fd AS VARCHAR), 'test_full', count(*) FILTER (mo AND d >= fd) FROM f, t GROUP BY 1""",
)
def M2_walk_forward_splits(spark, sf):
    return tr.split_sizes(prep.with_market_open(minute(spark, sf)), FOLDS)


@register(
    QUERIES,
    f"""WITH {BARS}, f AS (SELECT CAST(unnest(generate_series(DATE '2024-01-15', DATE '2024-02-02', INTERVAL 1 DAY)) AS DATE) AS fd)
    SELECT CAST(fd AS VARCHAR) AS fold FROM f WHERE fd <= (SELECT max(CAST(bar_ts AS DATE)) FROM bars WHERE {MARKET})""",
)
def M3_live_folds(spark, sf):
    live = tr.live_folds(prep.with_market_open(minute(spark, sf)), FOLDS)
    return spark.createDataFrame([(f.date,) for f in live], "fold string")


@register(
    QUERIES,
    f"""WITH {BARS} SELECT symbol, 'train' AS part, count(*) AS rows FROM bars WHERE CAST(bar_ts AS DATE) <= DATE '2024-01-16' GROUP BY 1
    UNION ALL SELECT symbol, 'test', count(*) FROM bars WHERE CAST(bar_ts AS DATE) >= DATE '2024-01-16' GROUP BY 1""",
)
def M8_cutoff_split(spark, sf):
    train, test = tr.cutoff_split(minute(spark, sf), "2024-01-16")
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return both.groupBy("symbol", "part").agg(F.count(F.lit(1)).alias("rows"))


@register(
    QUERIES,
    f"""WITH {BARS} SELECT symbol, training, count(*) AS rows FROM (
      SELECT symbol, CAST('0x' || substr(md5('42|' || symbol || '|' || CAST(bar_ts AS VARCHAR)), 1, 8) AS BIGINT) % 100 < 80 AS training FROM bars)
    GROUP BY 1, 2""",
)
def M7_random_split(spark, sf):
    """Rows per side of the repeatable 80/20 split."""
    side = tr.is_training_row(["symbol", "bar_ts"])
    return minute(spark, sf).groupBy("symbol", side.alias("training")).agg(F.count(F.lit(1)).alias("rows"))


# -- models ---------------------------------------------------------------------------------


def model_table(spark, sf):
    """Training table of the model queries, written once so that every pass reads plain columns."""
    labelled = reversal(spark, sf).select("symbol", "bar_ts", "slopes", "mapped_category")
    out, _ = assemble.training_table(base_table(spark, sf), feature_tables(spark, sf), labelled, check=False)
    return storage.stage(out, "training")


def _fitted(spark, sf):
    data = model_table(spark, sf)
    columns = tr.feature_columns(data)
    rows = tr.with_features(data, columns)
    fold = tr.Fold("2024-01-22")
    model = tr.fit_forest(rows.where(fold.masks()["train"]))
    return model, rows, fold, columns


@register(
    QUERIES,
    f"""WITH {BARS}, t AS (SELECT CAST(bar_ts AS DATE) AS d FROM bars WHERE {MARKET}),
    f AS (SELECT CAST(unnest(generate_series(DATE '2024-01-15', DATE '2024-02-02', INTERVAL 1 DAY)) AS DATE) AS fd),
    s AS (SELECT fd, 'test_1_day' AS split, count(*) FILTER (d = fd) AS n FROM f, t GROUP BY 1
      UNION ALL SELECT fd, 'test_10_day', count(*) FILTER (d BETWEEN fd AND fd + 9) FROM f, t GROUP BY 1
      UNION ALL SELECT fd, 'test_full', count(*) FILTER (d >= fd) FROM f, t GROUP BY 1)
    SELECT CAST(fd AS VARCHAR) AS fold, split, n AS rows, n AS summing_to_one, n AS predicted_by_largest FROM s
    WHERE n > 0 AND fd <= (SELECT max(d) FROM t)""",
)
def M4_M5_walk_forward(spark, sf):
    """The production forest on every live fold; each report's probabilities and predictions are checked."""
    parts = []
    for fold, _, reports in tr.walk_forward(model_table(spark, sf), FOLDS):
        for name, report in reports.items():
            p = [F.col(c) for c in "012"]
            largest = F.greatest(*p)
            parts.append(
                report.agg(
                    F.count(F.lit(1)).alias("rows"),
                    F.count_if(F.abs(p[0] + p[1] + p[2] - 1) < 1e-9).alias("summing_to_one"),
                    F.count_if(F.element_at(F.array(*p), F.col("pred").cast("int") + 1) == largest).alias("predicted_by_largest"),
                ).select(F.lit(fold.date).alias("fold"), F.lit(name).alias("split"), "*")
            )
    return functools.reduce(lambda x, y: x.unionByName(y), parts)


#: Size of the boosted model of the query.
BOOSTED = boosting.Params(rounds=15, depth=3, bins=32, patience=5)


@register(QUERIES)
def M4_M7_A19_boosted_curves(spark, sf):
    """Losses by round of the boosted model on the production evaluation sets, until a held-out fifth of the training rows stops gaining.

    No SQL: tests/test_boosting.py compares trees, curves and the stop with a version that walks over rows.
    """
    data = model_table(spark, sf)
    masks = tr.Fold("2024-01-22").masks()
    held_out = masks["train"] & ~tr.is_training_row(["symbol", "bar_ts"])
    sets = {"train": masks["train"] & tr.is_training_row(["symbol", "bar_ts"]), "held_out": held_out, **{n: c for n, c in masks.items() if n != "train"}}
    model = boosting.fit(data, tr.feature_columns(data), ["symbol", "bar_ts"], BOOSTED, sets["train"], sets, "held_out")
    return spark.createDataFrame(model.curve, "round int, eval_set string, rows long, merror double, mlogloss double")


#: Cut points of the stumps.
_EDGES = {"close": [10.0, 20.0, 30.0, 50.0, 75.0, 100.0], "high": [15.0, 40.0, 90.0], "close_diff": [-40.0, -10.0, 0.0, 10.0, 40.0], "slopes": [-1.005, -0.0305, 0.0105, 1.005]}
_EDGE_ROWS = ", ".join(f"('{name}', {place}, {cut}::DOUBLE)" for place, (name, cuts) in enumerate(_EDGES.items()) for cut in cuts)
_PURITY = "coalesce(({0}0 * {0}0 + {0}1 * {0}1 + {0}2 * {0}2)::DOUBLE / nullif({0}0 + {0}1 + {0}2, 0), 0)"


@register(
    QUERIES,
    f"""WITH {BARS}, {SMA5}, {_reversal('sma')},
    moved AS (SELECT symbol, bar_ts, close - lag(close) OVER {W} AS close_diff FROM bars),
    rows AS (SELECT CAST(l.bar_ts AS DATE) AS d, {CODE.format(c='l.category')} AS y, l.close, l.high, coalesce(m.close_diff, 0) AS close_diff, coalesce(l.slopes, 0) AS slopes
      FROM lab l JOIN moved m ON m.symbol = l.symbol AND m.bar_ts = l.bar_ts),
    edges(feature, place, cut) AS (VALUES {_EDGE_ROWS}),
    daily AS (SELECT d, feature, place, cut, y, count(*) AS n, count(*) FILTER (CASE feature WHEN 'close' THEN close WHEN 'high' THEN high
      WHEN 'close_diff' THEN close_diff ELSE slopes END <= cut) AS below FROM rows, edges GROUP BY ALL),
    f AS (SELECT CAST(unnest(generate_series(DATE '2024-01-15', DATE '2024-02-02', INTERVAL 1 DAY)) AS DATE) AS fd),
    counts AS (SELECT fd, feature, place, cut,
      {", ".join(f"CAST(coalesce(sum(below) FILTER (y = {k}), 0) AS BIGINT) AS l{k}, CAST(coalesce(sum(n) FILTER (y = {k}), 0) AS BIGINT) AS n{k}" for k in range(3))}
      FROM f, daily WHERE d < fd GROUP BY ALL),
    sides AS (SELECT *, n0 - l0 AS r0, n1 - l1 AS r1, n2 - l2 AS r2 FROM counts),
    gains AS (SELECT *, {_PURITY.format('l')} + {_PURITY.format('r')} - {_PURITY.format('n')} AS gain FROM sides WHERE l0 + l1 + l2 > 0 AND r0 + r1 + r2 > 0)
    SELECT CAST(fd AS VARCHAR) AS fold, feature, cut, l0 AS left_0, l1 AS left_1, l2 AS left_2, r0 AS right_0, r1 AS right_1, r2 AS right_2
    FROM gains WHERE gain > 1e-9 QUALIFY row_number() OVER (PARTITION BY fd ORDER BY gain DESC, place, cut) = 1""",
)
def M2_M4_fold_stumps(spark, sf):
    """The best cut of every fold's training rows, all folds from one count by day."""
    labelled = reversal(spark, sf).select("symbol", "bar_ts", "slopes", "mapped_category")
    bars = minute(spark, sf).select("symbol", "bar_ts", "close", "high")
    table, _ = assemble.training_table(bars, {"diff": ind.difference(bars.drop("high"), "minute")}, labelled, check=False)
    edges = [np.array(cuts) for cuts in _EDGES.values()]
    params = fold_forest.Params(trees=1, depth=1, bins=8, tried=len(edges), bootstrap=False)
    model = fold_forest.fit(table, list(_EDGES), ["symbol", "bar_ts"], FOLDS, params, edges=edges)
    trees = fold_forest.tree_table(model, table)
    side = lambda place, name: trees.where(F.col("place") == place).select("fold", *[F.col("labels")[k].alias(f"{name}_{k}") for k in range(3)])
    return trees.where("place = 0 AND feature IS NOT NULL").select("fold", "feature", "cut").join(side(1, "left"), "fold").join(side(2, "right"), "fold")


@register(QUERIES)
def M2_M4_M5_fold_forests(spark, sf):
    """Scores of the forests of all folds, fitted together, on their test sets.

    No SQL: tests/test_fold_forest.py compares trees and scores with fits of each fold that walk over rows.
    """
    data = model_table(spark, sf)
    params = fold_forest.Params(trees=20, depth=4)
    model = fold_forest.fit(data, tr.feature_columns(data), ["symbol", "bar_ts"], tr.live_folds(data, FOLDS), params)
    return fold_forest.evaluate_folds(model, data)


_FEATURES = ["open", "high", "low", "close", "close_sma_5m", "market_open", "close_14window_rsi", "close_diff", "slopes"]


@register(
    QUERIES,
    f"""WITH {BARS}, {SMA5}, {_reversal('sma')} SELECT CAST(len({_FEATURES}) AS BIGINT) AS features,
    CASE WHEN count(DISTINCT category) > 1 THEN 1.0 ELSE 0.0 END AS total FROM lab WHERE CAST(bar_ts AS DATE) < DATE '2024-01-22'""",
)
def M6_feature_importances(spark, sf):
    """One score per feature; the scores add up to one if there was anything to learn."""
    model, rows, _, columns = _fitted(spark, sf)
    scores = tr.importances(model, columns, rows)
    return scores.agg(F.count("*").alias("features"), F.round(F.sum("score"), 6).alias("total"))


@register(
    QUERIES,
    f"""WITH {BARS}, t AS (SELECT CAST(bar_ts AS DATE) AS d, {MARKET} AS mo FROM bars)
    SELECT 'train' AS eval_set, count(*) FILTER (d < DATE '2024-01-22') AS rows, CAST(0 AS BIGINT) AS differing FROM t
    UNION ALL SELECT 'test_1_day', count(*) FILTER (mo AND d = DATE '2024-01-22'), 0 FROM t
    UNION ALL SELECT 'test_10_day', count(*) FILTER (mo AND d BETWEEN DATE '2024-01-22' AND DATE '2024-01-31'), 0 FROM t
    UNION ALL SELECT 'test_full', count(*) FILTER (mo AND d >= DATE '2024-01-22'), 0 FROM t""",
)
def M9_M10_saved_model_scores(spark, sf):
    """Saves the model, loads it back, and compares both on every evaluation set."""
    model, rows, fold, _ = _fitted(spark, sf)
    path = storage.new_folder(spark, "model")
    tr.save_model(model, path)
    names = ["p0", "p1", "p2", "pred"]
    before = tr.class_probabilities(model, rows).withColumnsRenamed({c: f"{c}_before" for c in names})
    both = tr.class_probabilities(tr.load_model(path), before)
    differ = functools.reduce(lambda x, y: x | y, [F.col(c) != F.col(f"{c}_before") for c in names])
    masks = fold.masks()
    counts = both.agg(
        *[F.count_if(cond).alias(f"rows_{name}") for name, cond in masks.items()],
        *[F.count_if(cond & differ).alias(f"differing_{name}") for name, cond in masks.items()],
    )
    cells = [F.struct(F.lit(n).alias("eval_set"), F.col(f"rows_{n}").alias("rows"), F.col(f"differing_{n}").alias("differing")) for n in masks]
    return counts.select(F.inline(F.array(*cells)))
