"""Metric tables over predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.functions import metrics as M
from demandloom.schemas import TARGET

PREDICTION, BASELINE = "prediction", "baseline_prediction"
SLICES = ("store_id", "dept_id")


def baseline_forecast(df: DataFrame, lag: str = "sales_lag_7") -> DataFrame:
    """The lag as forecast; a frame without that feature takes the mean of its target."""
    if lag in df.columns:
        return df.withColumn(BASELINE, F.col(lag).cast("double"))
    mean = df.agg(F.avg(TARGET).alias(BASELINE))
    return df.crossJoin(F.broadcast(mean))


def overall_metrics(df: DataFrame) -> DataFrame:
    """All measures of model and baseline in one pass: one row."""
    measured = df.agg(
        M.rmse(TARGET, PREDICTION).alias("test_rmse"), M.mae(TARGET, PREDICTION).alias("test_mae"),
        M.wmape(TARGET, PREDICTION).alias("test_wmape"), M.r2(TARGET, PREDICTION).alias("test_r2"),
        M.error_mean(TARGET, PREDICTION).alias("error_mean"), M.error_std(TARGET, PREDICTION).alias("error_std"),
        M.rmse(TARGET, BASELINE).alias("baseline_rmse"), M.mae(TARGET, BASELINE).alias("baseline_mae"),
        M.wmape(TARGET, BASELINE).alias("baseline_wmape"), F.count(F.lit(1)).alias("rows"),
    )
    return measured.withColumns({
        "wmape_improvement_pct": M.improvement_pct(F.col("baseline_wmape"), F.col("test_wmape")),
        "abs_error_improvement_pct": M.improvement_pct(F.col("baseline_mae"), F.col("test_mae")),
    })


def slice_metrics(df: DataFrame, groups: Sequence[str] = SLICES) -> DataFrame:
    """``(slice, value, rmse, mae, wmape, bias, rows)`` for every group column in one scan.

    Grouping sets are combined inside the tasks, so what is shuffled is one row per task and slice value.
    """
    sets = [[F.col(name)] for name in groups]
    grouped = df.groupingSets(sets, *[F.col(name) for name in groups]).agg(
        *[F.grouping(name).alias(f"_{name}_out") for name in groups],
        M.rmse(TARGET, PREDICTION).alias("rmse"), M.mae(TARGET, PREDICTION).alias("mae"),
        M.wmape(TARGET, PREDICTION).alias("wmape"), M.bias(TARGET, PREDICTION).alias("bias"),
        F.count(F.lit(1)).alias("rows"),
    )
    label, value = None, None
    for name in groups:
        inside = F.col(f"_{name}_out") == 0
        label = F.when(inside, name) if label is None else label.when(inside, name)
        value = F.when(inside, F.col(name)) if value is None else value.when(inside, F.col(name))
    return grouped.select(
        label.alias("slice"), value.cast("string").alias("value"), "rmse", "mae", "wmape", "bias", "rows"
    )


def slice_summary(slices: DataFrame) -> DataFrame:
    """Spread of the weighted error over the values of each slice."""
    return slices.groupBy("slice").agg(
        F.avg("wmape").alias("avg_wmape"), F.min("wmape").alias("best_wmape"), F.max("wmape").alias("worst_wmape"),
        F.median("wmape").alias("median_wmape"), F.percentile("wmape", 0.9).alias("p90_wmape"),
    )


def best_candidate(metrics: DataFrame) -> DataFrame:
    """The candidate with the smallest validation error; on a tie the one listed later (higher ``priority``)."""
    return metrics.agg(
        F.min_by("model", F.struct("wmape", -F.col("priority"))).alias("best_model"), F.min("wmape").alias("best_wmape")
    )
