"""Walk-forward training and scoring with Spark ML."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions import times
from tickloom.operators.evaluate import argmax

# Model size, seed and number of classes.
TREES = 100
SEED = 420
CLASSES = 3
LABEL = "mapped_category"
NOT_FEATURES = ["symbol", "bar_ts", "category", LABEL]


@dataclass(frozen=True)
class Fold:
    """One test date: train on everything before it, test on it, on ten days, and on the rest."""

    date: str

    def shifted(self, days: int) -> str:
        return str(dt.date.fromisoformat(self.date) + dt.timedelta(days=days))

    def masks(self, market_only: bool = True) -> dict[str, Column]:
        """Row conditions by split; they are plain comparisons on ``bar_ts`` and reach the scan."""
        ts = F.col("bar_ts")
        tests = {
            "test_1_day": times.in_date_slice(ts, self.date, self.date),
            "test_10_day": times.in_date_slice(ts, self.date, self.shifted(9)),
            "test_full": times.in_date_slice(ts, first=self.date),
        }
        if market_only:
            tests = {name: cond & F.col("market_open") for name, cond in tests.items()}
        return {"train": times.in_date_slice(ts, last=self.shifted(-1)), **tests}


def folds(first: str, last: str) -> list[Fold]:
    start, end = dt.date.fromisoformat(first), dt.date.fromisoformat(last)
    return [Fold(str(start + dt.timedelta(days=i))) for i in range((end - start).days + 1)]


def live_folds(df: DataFrame, candidates: list[Fold], market_only: bool = True) -> list[Fold]:
    """Folds up to the first one without test rows; needs only the newest test row's date."""
    rows = df.where("market_open") if market_only else df
    newest = rows.agg(F.max(F.to_date("bar_ts")).alias("day")).first()["day"]
    return [f for f in candidates if newest is not None and f.date <= str(newest)]


def split_sizes(df: DataFrame, candidates: list[Fold], market_only: bool = True) -> DataFrame:
    """Rows of every split of every fold: the rows are counted by date, the folds add up dates."""
    day = F.to_date("bar_ts").cast("timestamp_ntz").alias("bar_ts")
    daily = df.groupBy(day, "market_open").agg(F.count(F.lit(1)).alias("_rows"))
    aggs, cells = [], []
    for i, fold in enumerate(candidates):
        for name, cond in fold.masks(market_only).items():
            aggs.append(F.coalesce(F.sum(F.when(cond, F.col("_rows"))), F.lit(0)).alias(f"_{i}_{name}"))
            cells.append(F.struct(F.lit(fold.date).alias("fold"), F.lit(name).alias("split"), F.col(f"_{i}_{name}").alias("rows")))
    return daily.agg(*aggs).select(F.inline(F.array(*cells)))


def cutoff_split(df: DataFrame, day: str, inclusive: bool = True) -> tuple[DataFrame, DataFrame]:
    """Train up to ``day``, test from it. With ``inclusive`` the day itself is in both parts."""
    last = day if inclusive else Fold(day).shifted(-1)
    ts = F.col("bar_ts")
    return df.where(times.in_date_slice(ts, last=last)), df.where(times.in_date_slice(ts, first=day))


def is_training_row(keys: list[str], share: int = 80, seed: int = 42) -> Column:
    """Repeatable random split: the same key is always on the same side.

    By md5, which other engines have too: the first 32 bits of the hash of seed and keys, in a hundred parts.
    """
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % 100 < share


def feature_columns(df: DataFrame) -> list[str]:
    numeric = (T.NumericType, T.BooleanType)
    return [
        f.name
        for f in df.schema.fields
        if f.name not in NOT_FEATURES and isinstance(f.dataType, numeric)
    ]


def with_features(df: DataFrame, columns: list[str]) -> DataFrame:
    """Adds the vector column ``features``; missing values become 0."""
    filled = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(f"_f_{i}") for i, c in enumerate(columns)]
    keep = df.columns
    parts = [f"_f_{i}" for i in range(len(columns))]
    assembled = VectorAssembler(inputCols=parts, outputCol="features").transform(
        df.select("*", *filled)
    )
    return assembled.select(*keep, "features")


def fit_forest(train: DataFrame, trees: int = TREES, depth: int = 6, seed: int = SEED) -> PipelineModel:
    """Multiclass random forest on ``features`` and the label column."""
    model = RandomForestClassifier(
        labelCol=LABEL, featuresCol="features", numTrees=trees, maxDepth=depth, seed=seed
    ).fit(train)
    return PipelineModel([model])


def fit_boosted(
    train: DataFrame,
    rounds: int = TREES,
    depth: int = 6,
    seed: int = SEED,
    validation: str | None = None,
) -> PipelineModel:
    """Boosted trees, one model per class against the rest.

    ``validation`` names a boolean column of rows that stop the boosting early.
    """
    stages = []
    for k in range(CLASSES):
        gbt = GBTClassifier(
            labelCol="_is_class", featuresCol="features", maxIter=rounds, maxDepth=depth, seed=seed
        )
        gbt = gbt.setPredictionCol(f"_pred{k}").setProbabilityCol(f"_prob{k}")
        gbt = gbt.setRawPredictionCol(f"_raw{k}")
        if validation:
            gbt = gbt.setValidationIndicatorCol(validation)
        rows = train.withColumn("_is_class", (F.col(LABEL) == k).cast("double"))
        stages.append(gbt.fit(rows))
    return PipelineModel(stages)


def class_probabilities(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Adds ``p0, p1, p2`` and ``pred``; one-against-rest scores are scaled to sum to 1."""
    scored = model.transform(rows)
    if "probability" in scored.columns:
        p = vector_to_array("probability")
        parts = [F.coalesce(F.get(p, F.lit(k)), F.lit(0.0)) for k in range(CLASSES)]
    else:
        own = [vector_to_array(f"_prob{k}")[1] for k in range(CLASSES)]
        total = own[0] + own[1] + own[2]
        parts = [F.coalesce(F.try_divide(c, total), F.lit(0.0)) for c in own]
    out = scored.select(*rows.columns, *[c.alias(f"p{k}") for k, c in enumerate(parts)])
    return out.withColumn("pred", argmax(["p0", "p1", "p2"]))


def scoring_report(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Probabilities, prediction, actual class and a few context columns."""
    context = ["market_open", "close"]
    for kind in ("ema", "sma"):
        for name in (f"close_diff_{kind}_5m", f"close_{kind}_5m"):
            if name in rows.columns:
                context.append(name)
                break
    scored = class_probabilities(model, rows)
    return scored.select(
        "symbol", "bar_ts",
        *[F.col(f"p{k}").alias(str(k)) for k in range(CLASSES)],
        "pred", F.col(LABEL).alias("actual"), *[c for c in context if c in rows.columns],
    )


def importances(model: PipelineModel, columns: list[str], like: DataFrame) -> DataFrame:
    """``(feature, score)``; the mean over the stages when there are several."""
    vectors = [s.featureImportances.toArray() for s in model.stages]
    scores = [(c, float(sum(v[i] for v in vectors) / len(vectors))) for i, c in enumerate(columns)]
    return like.sparkSession.createDataFrame(scores, "feature string, score double")


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def walk_forward(
    table: DataFrame,
    candidates: list[Fold],
    fit=fit_forest,
    market_only: bool = True,
    train_market_only: bool = False,
    model_root: str | None = None,
):
    """Yields ``(fold, model, {split: report})`` for each date that still has test rows.

    The table is read per fold with the date conditions pushed down; write it once (partitioned by
    date) before calling this. Splits without rows have no report.
    """
    columns = feature_columns(table)
    data = with_features(table, columns)
    live = live_folds(table, candidates, market_only)
    if not live:
        return
    sizes = {
        (r["fold"], r["split"]): r["rows"] for r in split_sizes(table, live, market_only).collect()
    }
    for fold in live:
        masks = fold.masks(market_only)
        train = data.where(masks["train"])
        model = fit(train.where("market_open") if train_market_only else train)
        if model_root:
            save_model(model, f"{model_root}/{fold.date}")
        reports = {
            name: scoring_report(model, data.where(masks[name]))
            for name in ("test_1_day", "test_10_day", "test_full")
            if sizes[(fold.date, name)]
        }
        yield fold, model, reports
