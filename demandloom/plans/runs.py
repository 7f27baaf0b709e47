"""End-to-end runs with their ledger."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandloom import schemas as S
from demandloom.config import PipelineConfig
from demandloom.operators import ledger
from demandloom.operators.quality import check, check_reference, enforce
from demandloom.operators.rules import status_rules
from demandloom.operators.storage import Batch, Snapshot, StaleWrite, current, expire, publish
from demandloom.plans import bronze, gold, silver
from demandloom.plans.dataset import build_dataset, feature_vectors, manifest_row
from demandloom.plans.evaluation import OVERALL, run_evaluation
from demandloom.plans.training import batch_predict, candidate_metrics, load_best, save_models, select_best, train_candidates, training_metric_rows
from demandloom.sources.libsvm import read_libsvm
from demandloom.sources.tables import read_days, read_table, row_count

STEPS = ("bronze", "silver", "gold")
METRICS = "ml_metrics"
ATTEMPTS = 20  # of a ledger change that other writers keep overtaking


def stage_key(run_id: str, stage: str) -> str:
    return f"{run_id}_{stage}"


class Ledger:
    """The run tables: small and keyed, each change a new version of them.

    An operation reads one snapshot and publishes all it changes as one step. If another writer has changed one of these
    tables meanwhile it is refused, and done again on what that writer left; so nothing is lost and ids stay unique.
    """

    def __init__(self, spark: SparkSession, cfg: PipelineConfig):
        self.spark, self.cfg = spark, cfg

    def snapshot(self) -> Snapshot:
        return current(self.spark, self.cfg.root.rstrip("/"))

    def read(self, name: str, schema: T.StructType, at: Snapshot | None = None) -> DataFrame:
        at, path = at or self.snapshot(), self.cfg.table(name)
        if at.table(path) is None:
            return self.spark.createDataFrame([], schema)
        return read_table(self.spark, path, schema, at)

    def write(self, tables: Mapping[str, DataFrame], base: Snapshot, dropped: Mapping[str, Sequence[str]] | None = None) -> None:
        """Publish the tables together; refused with ``StaleWrite`` if one of them has changed since ``base``."""
        publish([Batch(table.coalesce(1), self.cfg.table(name)) for name, table in tables.items()], base, dropped)

    def change(self, make: Callable[[Snapshot], Mapping[str, DataFrame]]) -> None:
        """Write what ``make`` builds on the newest snapshot; again if another writer was faster."""
        for attempt in range(1, ATTEMPTS + 1):
            at = self.snapshot()
            try:
                self.write(make(at), at)
                return
            except StaleWrite:
                if attempt == ATTEMPTS:
                    raise

    def etl_runs(self, at: Snapshot | None = None) -> DataFrame:
        return self.read("etl_pipeline_runs", S.ETL_RUN_SCHEMA, at)

    def etl_steps(self, at: Snapshot | None = None) -> DataFrame:
        return self.read("etl_pipeline_steps", S.ETL_STEP_SCHEMA, at)

    def ml_runs(self, at: Snapshot | None = None) -> DataFrame:
        return self.read("ml_pipeline_runs", S.ML_RUN_SCHEMA, at)

    def datasets(self, at: Snapshot | None = None) -> DataFrame:
        return self.read("ml_dataset", S.DATASET_SCHEMA, at)

    def ml_stages(self, at: Snapshot | None = None) -> DataFrame:
        return self.read("ml_runs", S.ML_STAGE_SCHEMA, at)

    def metrics(self, at: Snapshot | None = None) -> DataFrame:
        """``run_id, dataset_id, stage, metric, slice, value, ml_run_id`` of every stage that has reported."""
        return self.read(METRICS, S.METRIC_SCHEMA, at)

    def _row(self, schema: T.StructType, **values) -> DataFrame:
        row = tuple(values.get(field.name) for field in schema)
        return self.spark.createDataFrame([row], schema)

    def _next_id(self, table: DataFrame, column: str) -> int:
        return (table.agg(F.max(column)).first()[0] or 0) + 1

    def start_etl_run(self, run_date: dt.date) -> int:
        """Insert or reset the run of a date; a known run keeps its id and start."""
        cfg, now = self.cfg, self.cfg.now()
        none = {"ended_at": F.lit(None).cast("timestamp"), "error_message": F.lit(None).cast("string")}

        def make(at: Snapshot) -> Mapping[str, DataFrame]:
            runs = self.etl_runs(at)
            source = self._row(
                S.ETL_RUN_SCHEMA, run_id=self._next_id(runs, "run_id"), dag_id=cfg.etl_job,
                pipeline_name=cfg.pipeline_name, run_date=run_date, status="running", triggered_by=cfg.triggered_by,
                started_at=now, created_at=now, rows_bronze=0, rows_silver=0, rows_gold=0,
            )
            return {"etl_pipeline_runs": ledger.upsert(runs, source, S.ETL_RUN_KEY, ["status", "triggered_by"], none)}

        self.change(make)
        mine = (F.col("dag_id") == cfg.etl_job) & (F.col("pipeline_name") == cfg.pipeline_name)
        return self.etl_runs().where(mine & (F.col("run_date") == F.lit(run_date))).first()["run_id"]

    def start_step(self, run_id: int, step: str) -> None:
        """Insert or reset a step; its run must be known."""
        reset = {
            "ended_at": F.lit(None).cast("timestamp"), "error_message": F.lit(None).cast("string"),
            "input_rows": F.lit(0).cast("long"), "output_rows": F.lit(0).cast("long"),
        }

        def make(at: Snapshot) -> Mapping[str, DataFrame]:
            steps = self.etl_steps(at)
            source = self._row(
                S.ETL_STEP_SCHEMA, step_run_id=self._next_id(steps, "step_run_id"), run_id=run_id,
                dag_id=self.cfg.etl_job, step_name=step, status="running", started_at=self.cfg.now(), input_rows=0,
                output_rows=0,
            )
            enforce(check_reference(source, self.etl_runs(at), ["run_id"], "etl_pipeline_steps"))
            return {"etl_pipeline_steps": ledger.upsert(steps, source, S.ETL_STEP_KEY, ["status"], reset)}

        self.change(make)

    def finish_step(self, run_id: int, step: str, status: str, rows: tuple[int, int], error: str | None = None) -> None:
        change = self.spark.createDataFrame(
            [(run_id, self.cfg.etl_job, step, status, rows[0], rows[1], error)],
            "run_id long, dag_id string, step_name string, status string, input_rows long, output_rows long, "
            "error_message string",
        ).withColumn("ended_at", ledger.terminal_stamp("status", self.cfg.now()))
        self.change(lambda at: self._checked(
            "etl_pipeline_steps", ledger.update_by_key(self.etl_steps(at), change, S.ETL_STEP_KEY, must_match=True), S.STEP_STATES))

    def finish_etl_run(self, run_id: int) -> str:
        """Fold the steps into the run: state, message and row counts."""
        def make(at: Snapshot) -> Mapping[str, DataFrame]:
            steps = self.etl_steps(at).where(F.col("run_id") == run_id)
            change = (
                ledger.run_outcome(steps, STEPS).join(ledger.step_metrics(steps, STEPS), "run_id")
                .withColumn("ended_at", ledger.terminal_stamp("status", self.cfg.now()))
            )
            return self._checked("etl_pipeline_runs", ledger.update_by_key(self.etl_runs(at), change, ["run_id"]), S.RUN_STATES)

        self.change(make)
        return self.etl_runs().where(F.col("run_id") == run_id).first()["status"]

    def latest_etl_run(self, run_date: dt.date) -> int:
        """The newest run of a date (ties by id)."""
        chosen = self.etl_runs().where(F.col("run_date") == F.lit(run_date))
        row = ledger.latest_by(chosen, ["run_date"], ["created_at", "run_id"]).first()
        if row is None:
            raise ValueError(f"no run for {run_date.isoformat()}")
        return row["run_id"]

    def start_ml_run(self, run_id: str, run_date: dt.date) -> None:
        source = self._row(
            S.ML_RUN_SCHEMA, run_id=run_id, pipeline_name=self.cfg.pipeline_name, run_date=run_date, status="running",
            triggered_by=self.cfg.triggered_by, created_at=self.cfg.now(),
        )
        none = {"ended_at": F.lit(None).cast("timestamp"), "error_message": F.lit(None).cast("string")}
        self.change(lambda at: {"ml_pipeline_runs": ledger.upsert(
            self.ml_runs(at), source, S.ML_RUN_KEY, ["status", "triggered_by", "run_date"], none)})

    def finish_ml_run(self, run_id: str, status: str, error: str | None = None) -> None:
        change = self.spark.createDataFrame(
            [(run_id, status, error)], "run_id string, status string, error_message string"
        ).withColumn("ended_at", ledger.terminal_stamp("status", self.cfg.now()))
        self.change(lambda at: self._checked(
            "ml_pipeline_runs", ledger.update_by_key(self.ml_runs(at), change, S.ML_RUN_KEY, must_match=True), S.RUN_STATES))

    def log_dataset(self, manifest: dict) -> None:
        """Register a dataset; a known fingerprint keeps its row."""
        row = manifest_row(self.spark, manifest, self.cfg.now())

        def make(at: Snapshot) -> Mapping[str, DataFrame]:
            enforce(check_reference(row, self.ml_runs(at), ["run_id"], "ml_dataset"))
            return {"ml_dataset": ledger.insert_ignore(self.datasets(at), row, S.DATASET_KEY)}

        self.change(make)

    def start_stage(self, run_id: str, dataset_id: str, stage: str, tracking_id: str, source_tracking_id: str | None = None) -> None:
        """Insert or reset a stage; its run and its dataset must be known. ``source_tracking_id``: the stage it builds on."""
        source = self._row(
            S.ML_STAGE_SCHEMA, ml_run_id=stage_key(run_id, stage), run_id=run_id, dataset_id=dataset_id, stage=stage,
            status="running", tracking_id=tracking_id, source_tracking_id=source_tracking_id, created_at=self.cfg.now(),
        )
        none = {"ended_at": F.lit(None).cast("timestamp"), "error_message": F.lit(None).cast("string")}
        update = ["status", "tracking_id", "source_tracking_id"]

        def make(at: Snapshot) -> Mapping[str, DataFrame]:
            enforce(check_reference(source, self.ml_runs(at), ["run_id"], "ml_runs"))
            enforce(check_reference(source, self.datasets(at), ["dataset_id"], "ml_runs"))
            return {"ml_runs": ledger.upsert(self.ml_stages(at), source, S.ML_STAGE_KEY, update, none)}

        self.change(make)

    def finish_stage(self, run_id: str, dataset_id: str, stage: str, status: str, error: str | None = None) -> None:
        change = self.spark.createDataFrame(
            [(run_id, dataset_id, stage, status, error)],
            "run_id string, dataset_id string, stage string, status string, error_message string",
        ).withColumn("ended_at", ledger.terminal_stamp("status", self.cfg.now()))
        self.change(lambda at: self._checked(
            "ml_runs", ledger.update_by_key(self.ml_stages(at), change, S.ML_STAGE_KEY, must_match=True), S.RUN_STATES))

    def log_metrics(self, run_id: str, dataset_id: str, stage: str, rows: DataFrame) -> None:
        """Store ``metric, slice, value`` rows of a stage; a rerun of the stage replaces its rows and no others."""
        named = rows.select(
            F.lit(run_id).alias("run_id"), F.lit(dataset_id).alias("dataset_id"), F.lit(stage).alias("stage"),
            "metric", "slice", F.col("value").cast("double").alias("value"), F.lit(stage_key(run_id, stage)).alias("ml_run_id"),
        )
        known = self.ml_stages().where(F.col("stage") == stage)
        enforce(check_reference(named.limit(1), known, ["run_id", "dataset_id"], METRICS))
        publish([Batch(named, self.cfg.table(METRICS), "ml_run_id", sort=("metric", "slice"))])

    def delete_etl_run(self, run_id: int) -> None:
        """Remove a run and its steps in one step."""
        gone = self.spark.createDataFrame([(run_id,)], "run_id long")
        self.change(lambda at: {
            "etl_pipeline_runs": ledger.cascade_delete(self.etl_runs(at), gone, ["run_id"]),
            "etl_pipeline_steps": ledger.cascade_delete(self.etl_steps(at), gone, ["run_id"]),
        })

    def delete_ml_run(self, run_id: str) -> None:
        """Remove a run with its datasets, stages and metrics in one step; files of datasets and models stay."""
        gone = self.spark.createDataFrame([(run_id,)], "run_id string")
        for attempt in range(1, ATTEMPTS + 1):
            at = self.snapshot()
            stages = self.ml_stages(at)
            mine = [row["ml_run_id"] for row in stages.where(F.col("run_id") == run_id).select("ml_run_id").collect()]
            tables = {
                "ml_pipeline_runs": self.ml_runs(at), "ml_dataset": self.datasets(at), "ml_runs": stages,
            }
            try:
                self.write(
                    {name: ledger.cascade_delete(table, gone, ["run_id"]) for name, table in tables.items()}, at,
                    {self.cfg.table(METRICS): mine},
                )
                return
            except StaleWrite:
                if attempt == ATTEMPTS:
                    raise

    def _checked(self, name: str, table: DataFrame, states: Sequence[str]) -> Mapping[str, DataFrame]:
        enforce(check(table, status_rules(states), name))
        return {name: table}

    def lineage(self, metrics: bool = False) -> DataFrame:
        """Runs, datasets and stages of one snapshot; with their stored metrics if asked for."""
        at = self.snapshot()
        values = self.metrics(at).drop("ml_run_id") if metrics else None
        return ledger.lineage(self.ml_runs(at), self.datasets(at), self.ml_stages(at), values)


def _partition_rows(spark: SparkSession, cfg: PipelineConfig, table: str, days: Sequence[dt.date]) -> int:
    key_only = S.schema_of(["item_id", "run_date"])
    return row_count(read_days(spark, cfg.table(table), key_only, days)).first()["rows"]


def run_etl(
    spark: SparkSession,
    cfg: PipelineConfig,
    run_dates: Sequence[dt.date],
    sales_csv: str,
    calendar_csv: str | None = None,
    prices_csv: str | None = None,
) -> int:
    """Bronze, silver and gold of some days under one ledger run (dated by the newest day); returns its id.

    A failed step is recorded, ends the run as failed and is raised again.
    """
    book = Ledger(spark, cfg)
    run_id = book.start_etl_run(max(run_dates))
    steps: dict[str, tuple[Callable[[], object], str | None, str]] = {
        "bronze": (
            lambda: bronze.run_bronze(spark, cfg, run_dates, sales_csv, calendar_csv, prices_csv), None, bronze.BRONZE
        ),
        "silver": (lambda: silver.run_silver(spark, cfg, run_dates), bronze.BRONZE, silver.SILVER),
        "gold": (lambda: gold.run_gold(spark, cfg, run_dates), silver.SILVER, gold.GOLD),
    }
    try:
        for name, (work, source, target) in steps.items():
            book.start_step(run_id, name)
            read = 0 if source is None else _partition_rows(spark, cfg, source, run_dates)
            try:
                work()
            except Exception as error:
                book.finish_step(run_id, name, "failed", (read, 0), str(error))
                raise
            book.finish_step(run_id, name, "success", (read, _partition_rows(spark, cfg, target, run_dates)))
    finally:
        book.finish_etl_run(run_id)
    expire(spark, cfg.root.rstrip("/"), cfg.snapshots_kept)
    return run_id


def run_ml(spark: SparkSession, cfg: PipelineConfig, run_date: dt.date) -> dict:
    """Dataset, training, prediction and evaluation of a date under the ledger; returns manifest and overall metrics.

    Every stage stores its metrics: the candidates' validation errors, the number of predictions, and the evaluation.
    """
    book = Ledger(spark, cfg)
    etl_id = book.latest_etl_run(run_date)
    run_id = str(etl_id)
    book.start_ml_run(run_id, run_date)
    try:
        manifest = build_dataset(spark, cfg, run_date, etl_id, book.etl_runs())
        book.log_dataset(manifest)
    except Exception as error:
        book.finish_ml_run(run_id, "failed", str(error))
        raise
    home, features, dataset_id = manifest["dataset_dir"], manifest["features"], manifest["dataset_id"]
    models_dir = f"{cfg.table('models')}/{dataset_id}"

    def train() -> DataFrame:
        rows = {
            split: read_libsvm(spark, f"{home}/libsvm/{split}", len(features)) for split in ("train", "val")
        }
        models = train_candidates(rows["train"], rows["val"], cfg.model_rounds)
        scores = candidate_metrics(models, rows["val"], features)
        scores.coalesce(1).write.mode("overwrite").parquet(f"{models_dir}/metrics")
        scores = spark.read.parquet(f"{models_dir}/metrics")
        save_models(spark, models, select_best(scores), models_dir)
        return training_metric_rows(scores)

    def predict() -> DataFrame:
        _, model = load_best(spark, models_dir)
        scored = batch_predict(model, feature_vectors(spark, home, "test", features))
        scored.write.mode("overwrite").parquet(f"{home}/predictions")
        count = spark.read.parquet(f"{home}/predictions").agg(F.count(F.lit(1)).alias("value"))
        return count.select(F.lit("prediction_rows").alias("metric"), F.lit(OVERALL).alias("slice"), "value")

    def evaluate() -> DataFrame:
        return run_evaluation(spark, f"{home}/predictions", f"{home}/evaluation")

    before = None
    for stage, work in {"train": train, "predict": predict, "evaluate": evaluate}.items():
        tracking = f"{stage_key(run_id, stage)}-{dataset_id[:12]}"
        book.start_stage(run_id, dataset_id, stage, tracking, before)
        try:
            book.log_metrics(run_id, dataset_id, stage, work())
        except Exception as error:
            book.finish_stage(run_id, dataset_id, stage, "failed", str(error))
            book.finish_ml_run(run_id, "failed", str(error))
            raise
        book.finish_stage(run_id, dataset_id, stage, "success")
        before = tracking
    book.finish_ml_run(run_id, "success")
    expire(spark, cfg.root.rstrip("/"), cfg.snapshots_kept)
    told = book.metrics().where((F.col("ml_run_id") == stage_key(run_id, "evaluate")) & ~F.col("slice").contains("="))
    named = F.when(F.col("slice") == OVERALL, F.col("metric")).otherwise(F.concat_ws("_", "slice", "metric"))
    return {"manifest": manifest, "metrics": {row["name"]: row["value"] for row in told.select(named.alias("name"), "value").collect()}}
