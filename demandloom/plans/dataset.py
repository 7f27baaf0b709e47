"""Dataset: trailing window of gold rows, split by time, encoded and published under its fingerprint."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from demandloom.config import PipelineConfig
from demandloom.operators import splits
from demandloom.operators.encoding import encode, fit_vocabulary
from demandloom.operators.ledger import require_status
from demandloom.operators.quality import check, enforce
from demandloom.operators.rules import ml_critical_rules, ml_soft_rules
from demandloom.operators.storage import Swap, delete
from demandloom.plans.gold import GOLD
from demandloom.schemas import (
    DATASET_SCHEMA, DATE_COLUMN, GOLD_SCHEMA, MODEL_COLUMNS, SERIES_KEY, SPLIT_COLUMN, SPLITS, TARGET,
)
from demandloom.sources.libsvm import write_libsvm
from demandloom.sources.tables import read_days, scan_between

DATASETS = "datasets"


def assemble(encoded: DataFrame, features: list[str]) -> DataFrame:
    """Missing features are 0; the vector follows the feature list."""
    filled = encoded.fillna(0, subset=features)
    return VectorAssembler(inputCols=features, outputCol="features").transform(filled)


def window_rows(gold: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Model columns of the window with their split, narrowed."""
    rows = scan_between(gold.select(*MODEL_COLUMNS), start, end)
    return splits.time_split(splits.narrow(rows), start, end)


def write_splits(rows: DataFrame, path: str) -> None:
    """One folder per split in series and date order.

    The order is a range partitioning on split, series and date: no range depends on a single value, so a large
    series or split spreads over tasks.
    """
    rows.orderBy(SPLIT_COLUMN, *SERIES_KEY, DATE_COLUMN).write.partitionBy(SPLIT_COLUMN).parquet(path)


def read_split(spark: SparkSession, dataset_dir: str, split: str | None = None) -> DataFrame:
    rows = spark.read.parquet(f"{dataset_dir}/parquet")
    return rows if split is None else rows.where(F.col(SPLIT_COLUMN) == split)


def read_places(spark: SparkSession, path: str) -> DataFrame:
    """The rows of written splits with ``place``: their number, from 1, in the order of files and of rows inside them.

    Only one row per file is numbered in one group.
    """
    rows = spark.read.parquet(path).select(
        "*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    files = rows.groupBy(SPLIT_COLUMN, "_file").agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.partitionBy(SPLIT_COLUMN).orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    starts = files.select(SPLIT_COLUMN, "_file", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_start"))
    placed = rows.join(starts, [SPLIT_COLUMN, "_file"])
    return placed.withColumn("place", F.col("_start") + F.col("_row") + 1).drop("_file", "_row", "_start")


def read_vocabulary(spark: SparkSession, dataset_dir: str) -> DataFrame:
    return spark.read.parquet(f"{dataset_dir}/vocabulary")


def write_vocabulary(train: DataFrame, path: str) -> None:
    """One folder per column, so that each lookup's size is known when its join is planned."""
    fit_vocabulary(train).write.partitionBy("column").parquet(path)


def feature_vectors(spark: SparkSession, dataset_dir: str, split: str, features: list[str]) -> DataFrame:
    """The rows of a split with their feature vector; all other columns stay beside it."""
    rows = read_split(spark, dataset_dir, split)
    keep = rows.select("*", *[F.col(name).alias(f"raw_{name}") for name in ("item_id", "store_id", "dept_id")])
    return assemble(encode(keep, read_vocabulary(spark, dataset_dir)), features)


def counts_by_split(rows: DataFrame) -> dict[str, int]:
    found = {row[SPLIT_COLUMN]: row["rows"] for row in splits.split_counts(rows).collect()}
    return {name: found.get(name, 0) for name in SPLITS}


def _one_row_text(spark: SparkSession, path: str, payload) -> None:
    spark.createDataFrame([(json.dumps(payload, sort_keys=True),)], "value string").coalesce(1).write.text(path)


def build_dataset(spark: SparkSession, cfg: PipelineConfig, run_date: dt.date, run_id, runs: DataFrame) -> dict:
    """Build, check and publish a dataset; returns its manifest.

    Everything is written below a build folder that is renamed to the dataset's fingerprint at the end, so a
    failure leaves an older dataset of the same name as it was.
    """
    require_status(runs, run_id)
    start, end = splits.trailing_window(run_date, cfg.base_date)
    train_end, _ = splits.split_bounds(start, end)
    features = splits.model_features()
    root = cfg.table(DATASETS)
    build = spark.range(1).select(
        splits.build_id(cfg.pipeline_name, run_date, cfg.feature_version, run_id).alias("id")
    ).first()["id"]
    build_dir = f"{root}/_build-{build}"
    delete(spark, build_dir)
    try:
        days = [start + dt.timedelta(days=i) for i in range((end - start).days + 1)]
        gold = read_days(spark, cfg.table(GOLD), GOLD_SCHEMA, days)
        write_splits(window_rows(gold, start, end), f"{build_dir}/parquet")
        rows = read_split(spark, build_dir)
        enforce(check(rows, [*ml_critical_rules(), *ml_soft_rules()], "dataset"))
        write_vocabulary(rows.where(F.col(SPLIT_COLUMN) == "train"), f"{build_dir}/vocabulary")
        counts = counts_by_split(rows)
        for split in SPLITS:
            write_libsvm(
                feature_vectors(spark, build_dir, split, features), f"{build_dir}/libsvm/{split}", label=TARGET
            )
        schema, feature = splits.schema_hash(MODEL_COLUMNS), splits.feature_hash(cfg.feature_version, features)
        total = sum(counts.values())
        hashes = spark.range(1).select(
            schema.alias("schema_hash"), feature.alias("feature_hash"),
            splits.dataset_id(cfg.pipeline_name, run_date, run_id, schema, feature, F.lit(total)).alias("dataset_id"),
        ).first()
        content = splits.content_sums(rows).first()["content_hash"]
        final = f"{root}/{hashes['dataset_id']}"
        manifest = {
            **hashes.asDict(), "content_hash": content, "run_id": str(run_id), "pipeline_name": cfg.pipeline_name, "source_table": GOLD,
            "run_date": run_date.isoformat(), "dataset_start_date": start.isoformat(),
            "dataset_end_date": end.isoformat(), "train_end": train_end.isoformat(),
            "feature_version": cfg.feature_version, "features": features, "dataset_dir": final,
            "row_counts": {**counts, "total": total},
            "paths": {
                "parquet": {split: f"{final}/parquet/{SPLIT_COLUMN}={split}" for split in SPLITS},
                "libsvm": {split: f"{final}/libsvm/{split}" for split in SPLITS},
            },
        }
        _one_row_text(spark, f"{build_dir}/features", features)
        _one_row_text(spark, f"{build_dir}/manifest", manifest)
        swap = Swap(spark)
        try:
            swap.replace(build_dir, final)
        except BaseException:
            swap.undo()
            raise
        swap.finish()
        return manifest
    except BaseException:
        delete(spark, build_dir)
        raise


def manifest_row(spark: SparkSession, manifest: dict, clock: dt.datetime) -> DataFrame:
    """The registry row of a dataset."""
    counts, paths = manifest["row_counts"], manifest["paths"]["parquet"]
    row = (
        manifest["dataset_id"], manifest["run_id"], manifest["pipeline_name"], manifest["source_table"],
        dt.date.fromisoformat(manifest["dataset_start_date"]), dt.date.fromisoformat(manifest["dataset_end_date"]),
        paths["train"], paths["val"], paths["test"], counts["train"], counts["val"], counts["test"], counts["total"],
        manifest["feature_version"], manifest["feature_hash"], manifest["schema_hash"],
        manifest["content_hash"], clock,
    )
    return spark.createDataFrame([row], DATASET_SCHEMA)
