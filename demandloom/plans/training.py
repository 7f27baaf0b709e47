"""Boosted-tree candidates, their validation metrics, selection and batch prediction."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandloom.functions import metrics as M
from demandloom.operators.evaluation import BASELINE, PREDICTION, best_candidate
from demandloom.operators.storage import delete, exists
from demandloom.schemas import DATE_COLUMN, PREDICTION_COLUMNS, TARGET
from demandloom.session import ensure_checkpoint_dir, scratch_path

# The two candidates. Depth 6 has room for the 64 leaves of the first one; where a tree samples
# features, Spark samples per node.
# A tree level is one job.
FITTING = {"maxBins": 256, "cacheNodeIds": True, "maxMemoryInMB": 1024, "checkpointInterval": 10}
CANDIDATES: dict[str, dict] = {
    "gbt_depth6": {**FITTING, "stepSize": 0.05, "maxDepth": 6, "subsamplingRate": 0.8, "featureSubsetStrategy": "0.8"},
    "gbt_depth8": {**FITTING, "stepSize": 0.05, "maxDepth": 8, "subsamplingRate": 0.8, "featureSubsetStrategy": "0.8"},
}
MAX_ROUNDS = 1000
PATIENCE = 50  # rounds without a lower validation error that end boosting


def best_round(errors: Sequence[float], patience: int = PATIENCE) -> tuple[int, bool]:
    """The round (from 1) of the lowest error before ``patience`` rounds brought none lower, and whether that happened."""
    best = 0
    for at, error in enumerate(errors):
        if error < errors[best]:
            best = at
        elif at - best >= patience:
            return best + 1, True
    return best + 1, False


def cut_model(spark: SparkSession, model: GBTRegressionModel, rounds: int) -> GBTRegressionModel:
    """The model of its first ``rounds`` trees: its own saved tables, filtered and loaded again.

    Trees are numbered from 0 in the order they were boosted, in the node table (``treeID``) and in the table of their
    weights (first column); the metadata holds their number.
    """
    whole, part = scratch_path(spark, "model"), scratch_path(spark, "model")
    model.write().save(whole)
    try:
        spark.read.parquet(f"{whole}/data").where(F.col("treeID") < rounds).write.parquet(f"{part}/data")
        trees = spark.read.parquet(f"{whole}/treesMetadata")
        trees.where(F.col(trees.columns[0]) < rounds).write.parquet(f"{part}/treesMetadata")
        about = json.loads(spark.read.text(f"{whole}/metadata").first()["value"])
        about["numTrees"], about["paramMap"]["maxIter"] = rounds, rounds
        spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.text(f"{part}/metadata")
        return GBTRegressionModel.load(part)
    finally:
        delete(spark, whole)
        delete(spark, part)


def fit_with_patience(
    train: DataFrame, validation: DataFrame, rounds: int, params: Mapping[str, object], seed: int, patience: int = PATIENCE
) -> GBTRegressionModel:
    """Boost until the validation error has not fallen for ``patience`` rounds, and keep the rounds up to its lowest.

    The learner cannot go on from a model, so the reach is doubled until the stop lies within it; the same seed gives the
    same trees again. The rounds after the lowest are cut off the fitted model. Without validation rows all ``rounds`` are
    fitted.
    """
    def fit(reach: int) -> GBTRegressionModel:
        return GBTRegressor(maxIter=reach, seed=seed, **params).fit(train)

    if validation.isEmpty():
        return fit(rounds)
    reach = min(rounds, patience + patience // 4)
    while True:
        model = fit(reach)
        best, stopped = best_round(model.evaluateEachIteration(validation, "squared"), patience)
        if stopped or reach >= rounds:
            return model if best == reach else cut_model(train.sparkSession, model, best)
        reach = min(rounds, 2 * reach)


def train_candidates(
    train: DataFrame,
    validation: DataFrame,
    rounds: int = MAX_ROUNDS,
    candidates: Mapping[str, dict] = CANDIDATES,
    seed: int = 42,
) -> dict[str, GBTRegressionModel]:
    """Fit each candidate on ``label``/``features``; the validation rows end boosting, see ``fit_with_patience``.

    Rows stay on the executors: a round shuffles only the split statistics of its nodes. The tree learner cuts its
    lineage in the checkpoint folder every few rounds.
    """
    ensure_checkpoint_dir(train.sparkSession)
    rows, held = train.select("label", "features").persist(), validation.select("label", "features").persist()
    try:
        # The jobs of a round are short; candidates side by side keep the cores busy between them.
        with ThreadPoolExecutor(max_workers=max(1, len(candidates))) as pool:
            fits = {
                name: pool.submit(fit_with_patience, rows, held, rounds, params, seed) for name, params in candidates.items()
            }
            return {name: fit.result() for name, fit in fits.items()}
    finally:
        rows.unpersist()
        held.unpersist()


def candidate_metrics(
    models: Mapping[str, GBTRegressionModel], validation: DataFrame, features: list[str]
) -> DataFrame:
    """``(model, priority, rmse, wmape, improvement_pct)`` of every candidate and of the lag-7 baseline.

    All candidates score the validation rows in one pass; the baseline has no priority and is no candidate.
    """
    if "sales_lag_7" in features:
        baseline = vector_to_array("features")[features.index("sales_lag_7")]
        scored = validation.withColumn(BASELINE, baseline)
    else:
        scored = validation.crossJoin(F.broadcast(validation.agg(F.avg("label").alias(BASELINE))))
    for name, model in models.items():
        scored = model.copy({model.predictionCol: f"p_{name}"}).transform(scored)
    names = {BASELINE: BASELINE} | {name: f"p_{name}" for name in models}
    measured = scored.agg(*[
        F.struct(M.rmse("label", column).alias("rmse"), M.wmape("label", column).alias("wmape")).alias(name)
        for name, column in names.items()
    ])
    base = F.col(f"{BASELINE}.wmape")
    rows = [
        F.struct(
            F.lit(name).alias("model"), F.lit(priority).cast("int").alias("priority"),
            F.col(f"{name}.rmse").alias("rmse"), F.col(f"{name}.wmape").alias("wmape"),
            M.improvement_pct(base, F.col(f"{name}.wmape")).alias("improvement_pct"),
        )
        for name, priority in [(BASELINE, None), *[(name, i) for i, name in enumerate(models)]]
    ]
    return measured.select(F.inline(F.array(*rows)))


def training_metric_rows(metrics: DataFrame) -> DataFrame:
    """``metric, slice, value`` of ``candidate_metrics``, one slice per candidate and for the baseline."""
    named = metrics.select(F.concat(F.lit("model="), "model").alias("slice"), "rmse", "wmape", "improvement_pct")
    return named.unpivot(["slice"], ["rmse", "wmape", "improvement_pct"], "metric", "value").select("metric", "slice", "value")


def select_best(metrics: DataFrame) -> str:
    return best_candidate(metrics.where(F.col("priority").isNotNull())).first()["best_model"]


def save_models(spark: SparkSession, models: Mapping[str, GBTRegressionModel], best: str, path: str) -> None:
    for name, model in models.items():
        model.write().overwrite().save(f"{path}/model_{name}")
    spark.createDataFrame([(best,)], "best_model string").coalesce(1).write.mode("overwrite").json(f"{path}/selection")


def load_best(spark: SparkSession, path: str) -> tuple[str, GBTRegressionModel]:
    """The selected model by its recorded name; raises when none is recorded or the name is unknown."""
    if not exists(spark, f"{path}/selection"):
        raise ValueError(f"no best_model recorded in {path}")
    name = spark.read.schema("best_model string").json(f"{path}/selection").first()["best_model"]
    if name is None or not exists(spark, f"{path}/model_{name}"):
        raise ValueError(f"unknown best_model: {name}")
    return name, GBTRegressionModel.load(f"{path}/model_{name}")


def batch_predict(model: GBTRegressionModel, test: DataFrame) -> DataFrame:
    """Predictions beside the row's own key, target, baseline and slice keys: nothing is paired by position.

    ``test`` holds ``features``, the date, the target, ``sales_lag_7`` and the unencoded keys as ``raw_<name>``.
    """
    scored = model.copy({model.predictionCol: PREDICTION}).transform(test)
    return scored.select(
        F.col(PREDICTION).cast("double").alias(PREDICTION), F.col("sales_lag_7").cast("double").alias(BASELINE),
        F.col(TARGET).cast("double").alias(TARGET), F.col("raw_store_id").alias("store_id"),
        F.col("raw_dept_id").alias("dept_id"), F.col("raw_item_id").alias("item_id"), DATE_COLUMN,
    ).select(*PREDICTION_COLUMNS)
