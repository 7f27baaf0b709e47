"""Evaluation: overall and per-slice metrics of a predictions file, as tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandloom.operators.evaluation import SLICES, overall_metrics, slice_metrics, slice_summary
from demandloom.schemas import SCORED_COLUMNS
from demandloom.sources.tables import scan_columns

OVERALL = "all"
SLICE_MEASURES = ["rmse", "mae", "wmape", "bias", "rows"]


def evaluate(predictions: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Overall metrics, slice metrics and slice summary."""
    slices = slice_metrics(predictions)
    return overall_metrics(predictions), slices, slice_summary(slices)


def metric_rows(overall: DataFrame, slices: DataFrame, summary: DataFrame) -> DataFrame:
    """``metric, slice, value``: slice ``all`` for the whole, ``store_id=CA_1`` for a member, ``store_id`` for a summary."""
    def long(table: DataFrame, where, names: list[str]) -> DataFrame:
        cells = table.select(where.alias("slice"), *[F.col(name).cast("double").alias(name) for name in names])
        return cells.unpivot(["slice"], names, "metric", "value").select("metric", "slice", "value")

    return reduce(DataFrame.unionByName, [
        long(overall, F.lit(OVERALL), overall.columns),
        long(slices, F.concat_ws("=", "slice", F.coalesce("value", F.lit(""))), SLICE_MEASURES),
        long(summary, F.col("slice"), [name for name in summary.columns if name != "slice"]),
    ])


def run_evaluation(spark: SparkSession, predictions_path: str, output: str) -> DataFrame:
    """Evaluate a predictions file; writes ``metrics`` (see ``metric_rows``), ``slices`` and one CSV per slice column.

    The slice table has one row per store or department; it is written once and summed up from there. Returns the
    metrics as written.
    """
    predictions = scan_columns(spark, predictions_path, SCORED_COLUMNS)
    slice_metrics(predictions).write.mode("overwrite").parquet(f"{output}/slices")
    written = spark.read.parquet(f"{output}/slices")
    for name in SLICES:
        table = written.where(written["slice"] == name).withColumnRenamed("value", name).drop("slice")
        table.coalesce(1).write.mode("overwrite").option("header", True).csv(f"{output}/{name}_metrics")
    rows = metric_rows(overall_metrics(predictions), written, slice_summary(written))
    rows.coalesce(1).write.mode("overwrite").parquet(f"{output}/metrics")
    return spark.read.parquet(f"{output}/metrics")


def read_slice_csv(spark: SparkSession, output: str, name: str) -> DataFrame:
    """The CSV of one slice column, read back with its types."""
    schema = f"{name} string, rmse double, mae double, wmape double, bias double, rows long"
    return spark.read.schema(schema).option("header", True).csv(f"{output}/{name}_metrics")
