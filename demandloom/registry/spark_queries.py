"""One query per operator over the given tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandloom import fixtures as X
from demandloom import schemas as S
from demandloom.config import PipelineConfig
from demandloom.functions import metrics as M
from demandloom.functions import scalars as C
from demandloom.operators import encoding, evaluation, features, joins, ledger, quality, rules, splits, storage
from demandloom.operators.dedup import keep_first
from demandloom.plans import bronze as bronze_plan
from demandloom.plans import dataset as dataset_plan
from demandloom.plans import gold as gold_plan
from demandloom.plans import runs as runs_plan
from demandloom.plans import training
from demandloom.plans.evaluation import SLICE_MEASURES, read_slice_csv, run_evaluation
from demandloom.session import configure, scratch_path
from demandloom.sources import csv, libsvm, tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        return function(spark, sf_dir)

    run.__name__, run.__doc__ = function.__name__, function.__doc__
    QUERIES[function.__name__] = run
    return function


def clock() -> Column:
    return F.lit(X.CLOCK.isoformat(sep=" ")).cast("timestamp")


def plain_time(df: DataFrame, *names: str) -> DataFrame:
    """Timestamps without zone, so that the result does not depend on where it is read."""
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in names})


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    return df.select(*[
        F.round(field.name, places).alias(field.name) if field.dataType.typeName() in ("double", "float")
        else F.col(field.name)
        for field in df.schema
    ])


def silver_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.silver(
        X.sales_daily(spark, sf_dir), X.calendar(spark, sf_dir), X.sell_prices(spark, sf_dir), clock(), X.VERSION
    )


def gold_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.gold(silver_rows(spark, sf_dir), X.first_day(spark, sf_dir))


def history_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.sales_daily(spark, sf_dir).select("item_id", "store_id", "run_date", "sales")


def window_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gold rows of the dataset window."""
    start, end = splits.trailing_window(X.ML_RUN_DATE, X.BASE)
    return tables.scan_between(gold_rows(spark, sf_dir), start, end)


def split_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    start, end = splits.trailing_window(X.ML_RUN_DATE, X.BASE)
    return splits.time_split(gold_rows(spark, sf_dir), start, end)


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold rows with the week's mean as prediction and the lag as baseline."""
    rows = evaluation.baseline_forecast(gold_rows(spark, sf_dir))
    return rows.select(
        F.col("sales_roll_mean_7").alias("prediction"), "baseline_prediction", F.col("sales").cast("double").alias("sales"),
        "store_id", "dept_id",
    )


# ---- sources -------------------------------------------------------------------------------------------------


@query
def wide_slice(spark, sf_dir):
    """One day's column of the wide file."""
    path = X.write_wide_csv(spark, sf_dir)
    return csv.read_wide_sales(spark, path, X.BASE, [X.RUN_DATE], X.VERSION)


@query
def wide_unpivot(spark, sf_dir):
    """All days of the wide file unfolded, summed up per item and day."""
    rows = csv.read_wide_sales(spark, X.write_wide_csv(spark, sf_dir), X.BASE, None, X.VERSION)
    return rows.groupBy("item_id", "d", "run_date").agg(
        F.count(F.lit(1)).alias("series"), F.sum("sales").alias("sales")
    )


@query
def calendar_load(spark, sf_dir):
    path = scratch_path(spark, "calendar-csv")
    upper = {name: name.upper().replace("SNAP", "snap") for name in S.SNAP_COLUMNS}
    X.calendar(spark, sf_dir).withColumnsRenamed(upper).write.option("header", True).csv(path)
    return csv.read_calendar(spark, path)


@query
def prices_load(spark, sf_dir):
    path = scratch_path(spark, "prices-csv")
    X.dirty_prices(X.sell_prices(spark, sf_dir)).write.option("header", True).csv(path)
    return csv.read_prices(spark, path)


@query
def scan_partition(spark, sf_dir):
    return tables.scan_partition(X.bronze_table(spark, sf_dir), X.RUN_DATE).select(*S.BRONZE_COLUMNS)


@query
def scan_history(spark, sf_dir):
    return tables.scan_history(X.bronze_table(spark, sf_dir), X.RUN_DATE).select(
        "item_id", "store_id", "run_date", "sales"
    )


@query
def scan_between(spark, sf_dir):
    start, end = splits.trailing_window(X.ML_RUN_DATE, X.BASE)
    return tables.scan_between(X.bronze_table(spark, sf_dir), start, end).select(
        "item_id", "store_id", "run_date", "sales"
    )


@query
def scan_required_cols(spark, sf_dir):
    names = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity"]
    return tables.scan_columns(spark, f"{sf_dir}/lineitem.parquet", names)


@query
def libsvm_roundtrip(spark, sf_dir):
    """Order lines as learner rows: written, read back, and taken apart again."""
    path = scratch_path(spark, "libsvm")
    names = ["l_extendedprice", "l_discount", "l_tax"]
    lines = X.table(spark, sf_dir, "lineitem").select(F.col("l_quantity").alias("sales"), *names)
    libsvm.write_libsvm(dataset_plan.assemble(lines, names), path, label="sales")
    read = libsvm.read_libsvm(spark, path, len(names)).withColumn("cells", vector_to_array("features"))
    return read.select("label", *[F.col("cells")[i].alias(name) for i, name in enumerate(names)])


# ---- sinks ---------------------------------------------------------------------------------------------------


@query
def partition_overwrite(spark, sf_dir):
    """The days from the run date on are loaded twice; the second load replaces the first."""
    root = f"{scratch_path(spark, 'warehouse')}/sales"
    rows = X.sales_daily(spark, sf_dir)
    storage.overwrite_partitions(rows, root)
    again = rows.where(F.col("run_date") >= F.lit(X.RUN_DATE)).withColumns(
        {"sales": F.col("sales") + 1, "_pipeline_version": F.lit("v2")}
    )
    storage.overwrite_partitions(again, root)
    return tables.read_table(spark, root, S.BRONZE_SCHEMA)


@query
def dimension_overwrite(spark, sf_dir):
    """A price table replaced by a version computed from itself."""
    root = f"{scratch_path(spark, 'warehouse')}/prices"
    order = ("wm_yr_wk", "store_id", "item_id")
    storage.overwrite_table(X.sell_prices(spark, sf_dir), root, sort=order)
    raised = tables.read_table(spark, root, S.PRICE_SCHEMA).withColumn("sell_price", F.col("sell_price") * 2)
    storage.overwrite_table(raised, root, sort=order, rules=rules.price_rules(), layer="sell_prices")
    return tables.read_table(spark, root, S.PRICE_SCHEMA)


@query
def publish_if_valid(spark, sf_dir):
    """A batch with negative sales and an empty batch are refused and leave the table alone."""
    root = f"{scratch_path(spark, 'warehouse')}/sales"
    rows = X.sales_daily(spark, sf_dir)
    gate = {"rules": rules.bronze_rules(), "layer": "bronze"}
    storage.overwrite_partitions(rows, root, **gate)
    refused = 0
    for bad in (rows.withColumn("sales", -F.col("sales")), rows.where("false")):
        try:
            storage.overwrite_partitions(bad, root, **gate)
        except quality.QualityError:
            refused += 1
    return tables.read_table(spark, root, S.BRONZE_SCHEMA).withColumn("refused", F.lit(refused))


@query
def bronze_run(spark, sf_dir):
    """Load of one day from a wide file with malformed cells and repeated lines, and of both dimensions with it."""
    cfg = X.pipeline(spark)
    path, calendar_path, prices_path = X.write_wide_csv(spark, sf_dir, dirty=True), scratch_path(spark, "csv"), scratch_path(spark, "csv")
    X.calendar(spark, sf_dir).write.option("header", True).csv(calendar_path)
    X.dirty_prices(X.sell_prices(spark, sf_dir)).write.option("header", True).csv(prices_path)
    bronze_plan.run_bronze(spark, cfg, [X.RUN_DATE], path, calendar_path, prices_path)
    days = tables.read_table(spark, cfg.table(bronze_plan.CALENDAR), S.CALENDAR_SCHEMA).agg(
        F.count(F.lit(1)).alias("calendar_rows"), F.sum("snap_tx").alias("snap_days"))
    prices = tables.read_table(spark, cfg.table(bronze_plan.PRICES), S.PRICE_SCHEMA).agg(
        F.count(F.lit(1)).alias("price_rows"), F.count("sell_price").alias("readable_prices"))
    sales = tables.read_table(spark, cfg.table(bronze_plan.BRONZE), S.BRONZE_SCHEMA)
    return sales.crossJoin(F.broadcast(days)).crossJoin(F.broadcast(prices))  # one row each


@query
def split_sink(spark, sf_dir):
    """Split rows written to one folder per split and read back."""
    path = scratch_path(spark, "splits")
    dataset_plan.write_splits(
        split_rows(spark, sf_dir).select("item_id", "store_id", "run_date", "sales", "sell_price", "split"), path
    )
    return spark.read.parquet(path).select("item_id", "store_id", "run_date", "sales", "sell_price", "split")


@query
def dataset_metadata(spark, sf_dir):
    """The manifest of the dataset window, written as JSON and read back."""
    start, end = splits.trailing_window(X.ML_RUN_DATE, X.BASE)
    names = splits.model_features()
    counts = splits.split_counts(split_rows(spark, sf_dir)).agg(
        *[
            F.coalesce(F.sum(F.when(F.col("split") == name, F.col("rows"))), F.lit(0)).alias(f"{name}_row_count")
            for name in S.SPLITS
        ],
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total_row_count"),
    )
    schema, feature = splits.schema_hash(S.MODEL_COLUMNS), splits.feature_hash("v1", names)
    manifest = counts.select(
        "*", schema.alias("schema_hash"), feature.alias("feature_hash"),
        splits.dataset_id(
            "demand_features", X.ML_RUN_DATE, 1, schema, feature, F.col("total_row_count")
        ).alias("dataset_id"),
        F.lit(start).alias("dataset_start_date"), F.lit(end).alias("dataset_end_date"),
        F.lit(len(names)).alias("feature_count"),
    )
    path = scratch_path(spark, "manifest")
    manifest.coalesce(1).write.json(path)
    return spark.read.schema(manifest.schema).json(path)


# ---- scalar functions ----------------------------------------------------------------------------------------


def _lines(spark, sf_dir) -> DataFrame:
    return X.table(spark, sf_dir, "lineitem").withColumn("run_date", F.col("l_shipdate").cast("date"))


@query
def day_index(spark, sf_dir):
    return _lines(spark, sf_dir).select("l_orderkey", "l_linenumber", "run_date", C.day_id("run_date", X.BASE).alias("d"))


@query
def bronze_project(spark, sf_dir):
    long = X.sales_daily(spark, sf_dir).select(*S.SALES_IDS, "d", F.col("sales").cast("string").alias("sales"))
    return csv.bronze_rows(long, C.day_date("d", X.BASE), "v7")


@query
def safe_int(spark, sf_dir):
    text = X.dirty_text(F.col("l_returnflag"), F.col("l_linestatus"), F.col("l_quantity"))
    return _lines(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", "l_suppkey", text.alias("raw"), C.safe_int(text).alias("sales")
    )


@query
def stamp_columns(spark, sf_dir):
    stamped = joins.stamp(history_rows(spark, sf_dir), clock(), "v3").withColumn("batch_date", F.lit(X.RUN_DATE))
    return plain_time(stamped, "_processed_time")


@query
def sentinel_null(spark, sf_dir):
    return joins.clean_events(X.calendar(spark, sf_dir)).select("d", "date", *S.EVENT_COLUMNS)


@query
def null_default(spark, sf_dir):
    return X.calendar(spark, sf_dir).select("d", *[C.null_default(name).alias(name) for name in S.SNAP_COLUMNS])


@query
def lag_fallback(spark, sf_dir):
    columns = features.lag_columns() | features.rolling_mean_columns()
    return features.fill_lags(history_rows(spark, sf_dir).withColumns(columns)).select(
        "item_id", "store_id", "run_date", *S.LAG_COLUMNS
    )


@query
def rolling_default(spark, sf_dir):
    columns = features.rolling_mean_columns() | features.rolling_std_columns()
    return features.fill_rolling(history_rows(spark, sf_dir).withColumns(columns)).select(
        "item_id", "store_id", "run_date", *S.MEAN_COLUMNS, *S.STD_COLUMNS
    )


@query
def date_parts(spark, sf_dir):
    return features.add_calendar_features(X.calendar(spark, sf_dir).select("d", "date"))


@query
def cold_start(spark, sf_dir):
    return features.add_cold_start(history_rows(spark, sf_dir)).select(
        "item_id", "store_id", "run_date", "is_cold_start"
    )


@query
def narrow_types(spark, sf_dir):
    return splits.narrow(gold_rows(spark, sf_dir).select(*S.MODEL_COLUMNS))


@query
def safe_date(spark, sf_dir):
    text = X.dirty_date_text(F.col("o_orderstatus"), F.col("o_orderdate"))
    return X.table(spark, sf_dir, "orders").select("o_orderkey", text.alias("raw"), C.safe_date(text).alias("day"))


def _staged_split(spark, sf_dir) -> DataFrame:
    """The split rows as a table, as a dataset build keeps them: gold is computed once for all that reads them."""
    path = scratch_path(spark, "split-rows")
    split_rows(spark, sf_dir).select(*S.MODEL_COLUMNS, "split").write.partitionBy("split").parquet(path)
    return spark.read.parquet(path)


def _vocabulary(rows: DataFrame) -> DataFrame:
    """Fitted on the training rows and kept as a table, as a dataset build does."""
    spark = rows.sparkSession
    path = scratch_path(spark, "vocabulary")
    dataset_plan.write_vocabulary(rows.where("split = 'train'"), path)
    return spark.read.parquet(path)


def _cells(assembled: DataFrame, names: list[str]) -> list[Column]:
    cells = vector_to_array("features")
    return [F.round(cells[i], 4).alias(f"f_{name}") for i, name in enumerate(names)]


@query
def feature_vector(spark, sf_dir):
    """The model vector of every split row, cell by cell."""
    names, rows = splits.model_features(), _staged_split(spark, sf_dir)
    keyed = splits.narrow(rows).select("*", *[F.col(name).alias(f"key_{name}") for name in S.SERIES_KEY])
    assembled = dataset_plan.assemble(encoding.encode(keyed, _vocabulary(rows)), names)
    return assembled.select(
        F.col("key_item_id").alias("item_id"), F.col("key_store_id").alias("store_id"), "run_date", *_cells(assembled, names))


@query
def baseline_forecast(spark, sf_dir):
    """The lag as forecast, and the mean where the lag is not a column."""
    gold = gold_rows(spark, sf_dir).select("item_id", "store_id", "run_date", "sales", "sales_lag_7")
    lagged = evaluation.baseline_forecast(gold).drop("sales_lag_7").withColumn("kind", F.lit("lag"))
    flat = evaluation.baseline_forecast(history_rows(spark, sf_dir)).withColumn("kind", F.lit("mean"))
    return rounded(lagged.unionByName(flat))


@query
def improvement_pct(spark, sf_dir):
    """Per store: how much smaller the prediction's absolute error is than the baseline's."""
    errors = predictions(spark, sf_dir).groupBy("store_id").agg(
        M.mae("sales", "prediction").alias("model"), M.mae("sales", "baseline_prediction").alias("baseline")
    )
    return rounded(errors.select("store_id", M.improvement_pct(F.col("baseline"), F.col("model")).alias("pct")), 4)


# ---- filters and joins ---------------------------------------------------------------------------------------


@query
def status_gate(spark, sf_dir):
    """The first successful run passes; the failed and the missing one are refused."""
    runs = X.etl_runs(spark, sf_dir)
    picks = runs.groupBy("status").agg(F.min("run_id").alias("run_id")).collect()
    chosen = {row["status"]: row["run_id"] for row in picks}
    refused = 0
    for run_id in (chosen.get("failed"), -1):
        try:
            ledger.require_status(runs, run_id)
        except ValueError:
            refused += 1
    passed = ledger.require_status(runs, chosen["success"])
    return runs.where(F.col("run_id") == passed["run_id"]).select(
        "run_id", "dag_id", "run_date", "status", F.lit(refused).alias("refused")
    )


@query
def silver_calendar_join(spark, sf_dir):
    joined = joins.join_calendar(X.sales_daily(spark, sf_dir), X.calendar(spark, sf_dir))
    return joined.select("item_id", "store_id", "run_date", "date", "sales", "wm_yr_wk", "weekday", "wday", "month", "year")


@query
def silver_price_join(spark, sf_dir):
    joined = joins.join_calendar(X.sales_daily(spark, sf_dir), X.calendar(spark, sf_dir))
    return joins.join_prices(joined, X.sell_prices(spark, sf_dir)).select(
        "item_id", "store_id", "run_date", "wm_yr_wk", "sales", "sell_price"
    )


@query
def silver_partition(spark, sf_dir):
    """The silver rows of every day (a day's partition is a filter on the date)."""
    return plain_time(silver_rows(spark, sf_dir), "_processed_time")


@query
def ordinal_encode(spark, sf_dir):
    rows = _staged_split(spark, sf_dir)
    named = rows.select(
        F.col("item_id").alias("item"), F.col("store_id").alias("store"), "run_date", "split", *S.CATEGORICAL_COLUMNS
    )
    return encoding.encode(named, _vocabulary(rows))


@query
def latest_run(spark, sf_dir):
    """The newest run of every date."""
    return ledger.latest_by(
        X.etl_runs(spark, sf_dir).select("run_date", "run_id", "status", "created_at"), ["run_date"],
        ["created_at", "run_id"],
    ).drop("created_at")


# ---- aggregations --------------------------------------------------------------------------------------------


@query
def table_count(spark, sf_dir):
    """All rows of the sales table and those of one day."""
    table = X.bronze_table(spark, sf_dir)
    return tables.row_count(table).withColumn("scope", F.lit("all")).unionByName(
        tables.row_count(table, X.RUN_DATE).withColumn("scope", F.lit("day"))
    )


@query
def duplicate_grain(spark, sf_dir):
    """Order lines whose key occurs more than once."""
    return quality.duplicate_keys(X.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def split_counts(spark, sf_dir):
    counts = splits.split_counts(split_rows(spark, sf_dir))
    return counts.unionByName(counts.agg(F.lit("total").alias("split"), F.sum("rows").alias("rows")))


@query
def vocabulary(spark, sf_dir):
    return encoding.fit_vocabulary(split_rows(spark, sf_dir).where("split = 'train'"))


@query
def overall_metrics(spark, sf_dir):
    return rounded(evaluation.overall_metrics(predictions(spark, sf_dir)))


@query
def baseline_metrics(spark, sf_dir):
    return rounded(
        evaluation.overall_metrics(predictions(spark, sf_dir)).select(
            "baseline_rmse", "baseline_mae", "baseline_wmape", "rows"
        )
    )


@query
def slice_metrics(spark, sf_dir):
    return rounded(evaluation.slice_metrics(predictions(spark, sf_dir)))


@query
def slice_summary(spark, sf_dir):
    return rounded(evaluation.slice_summary(evaluation.slice_metrics(predictions(spark, sf_dir))))


@query
def evaluate_run(spark, sf_dir):
    """Predictions written and evaluated: the stored metrics, those of slice members taken from the CSV files."""
    path, output = scratch_path(spark, "predictions"), scratch_path(spark, "evaluation")
    predictions(spark, sf_dir).write.parquet(path)
    stored = run_evaluation(spark, path, output).where(~F.col("slice").contains("="))
    for name in evaluation.SLICES:
        members = read_slice_csv(spark, output, name).select(
            F.concat(F.lit(f"{name}="), name).alias("slice"), *[F.col(m).cast("double").alias(m) for m in SLICE_MEASURES])
        stored = stored.unionByName(members.unpivot(["slice"], SLICE_MEASURES, "metric", "value"))
    return rounded(stored, 5)


@query
def best_model(spark, sf_dir):
    """Four stand-in candidates, two of them equal: the smaller error wins, a tie goes to the later one."""
    rows = gold_rows(spark, sf_dir)
    candidates = ["sales_roll_mean_28", "sales_roll_mean_14", "sales_lag_7", "sales_lag_1"]
    measured = rows.agg(*[M.wmape("sales", name).alias(name) for name in candidates], F.count(F.lit(1)).alias("n"))
    table = measured.unpivot([], candidates, "model", "wmape").withColumn(
        "priority", F.array_position(F.array(*[F.lit(name) for name in candidates]), F.col("model")).cast("int")
    )
    tied = table.unionByName(table.withColumns(
        {"model": F.concat("model", F.lit("_again")), "priority": F.col("priority") + len(candidates)}
    ))
    return rounded(evaluation.best_candidate(tied))


@query
def dataset_window(spark, sf_dir):
    """Window and split bounds for every possible run date."""
    days = X.calendar(spark, sf_dir).select(F.col("date").alias("run_date"))
    return splits.add_window_bounds(days, X.BASE)


# ---- windows -------------------------------------------------------------------------------------------------


@query
def lag_features(spark, sf_dir):
    return history_rows(spark, sf_dir).withColumns(features.lag_columns())


@query
def rolling_mean(spark, sf_dir):
    return rounded(history_rows(spark, sf_dir).withColumns(features.rolling_mean_columns()), 4)


@query
def rolling_std(spark, sf_dir):
    return rounded(history_rows(spark, sf_dir).withColumns(features.rolling_std_columns()), 4)


@query
def gold_partition(spark, sf_dir):
    """Features of one day: its rows in full, older ones with the four columns the windows read."""
    silver = silver_rows(spark, sf_dir)
    targets = tables.scan_partition(silver, X.RUN_DATE)
    history = silver.where(F.col("run_date") < F.lit(X.RUN_DATE)).select(*gold_plan.HISTORY_COLUMNS)
    rows = gold_plan.gold_for(history, targets, [X.RUN_DATE], X.first_day(spark, sf_dir))
    return plain_time(rows, "_processed_time")


@query
def gold_backfill(spark, sf_dir):
    """Features of all days in one pass."""
    return plain_time(gold_rows(spark, sf_dir), "_processed_time")


@query
def dataset_order(spark, sf_dir):
    """Export order: each row's place among all rows of its split, by file and position in the written files."""
    path = scratch_path(spark, "splits")
    dataset_plan.write_splits(split_rows(spark, sf_dir).select("item_id", "store_id", "run_date", "sales", "split"), path)
    return dataset_plan.read_places(spark, path).select("split", "item_id", "store_id", "run_date", "sales", "place")


@query
def dedup_keep_first(spark, sf_dir):
    lines = X.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"
    )
    order = F.struct("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    return keep_first(lines, ["l_orderkey", "l_linenumber"], order)


# ---- quality -------------------------------------------------------------------------------------------------


def dirty_silver(spark, sf_dir) -> DataFrame:
    return X.dirty_silver(silver_rows(spark, sf_dir))


def _kind(report: DataFrame, *prefixes: str) -> DataFrame:
    chosen = F.lit(False)
    for prefix in prefixes:
        chosen = chosen | F.col("rule").startswith(prefix)
    return report.where(chosen)


@query
def schema_contract(spark, sf_dir):
    """Order lines with text cells against a typed contract."""
    text = X.dirty_text(F.col("l_returnflag"), F.col("l_linestatus"), F.col("l_quantity"))
    raw = _lines(spark, sf_dir).select(
        F.col("l_orderkey").cast("string").alias("d"), text.alias("sales"), F.col("run_date").cast("string").alias("run_date")
    )
    _, report = quality.conform(raw, S.schema_of(["d", "sales", "run_date"]), "bronze")
    return report


@query
def rule_not_null(spark, sf_dir):
    return quality.check(dirty_silver(spark, sf_dir), rules.silver_not_null(), "silver")


@query
def rule_bounds(spark, sf_dir):
    return _kind(quality.check(dirty_silver(spark, sf_dir), rules.silver_rules(False), "silver"), "at_least", "in_range")


@query
def rule_domain(spark, sf_dir):
    dirty = features.gold(dirty_silver(spark, sf_dir), X.BASE)
    report = quality.check(dirty, rules.gold_rules(X.STATES[1:], X.EVENT_TYPES, False), "gold")
    return _kind(report, "one_of").unionByName(
        quality.check(X.etl_runs(spark, sf_dir), rules.status_rules(S.RUN_STATES[1:]), "etl_pipeline_runs")
    )


@query
def single_batch(spark, sf_dir):
    """A whole history holds many dates but one version."""
    names = ["run_date", "_pipeline_version"]
    return quality.check(X.sales_daily(spark, sf_dir), [quality.single_value(name) for name in names], "bronze")


@query
def rule_time_order(spark, sf_dir):
    """Rows stamped a fixed time; those dated after it break the rule."""
    stamped = joins.stamp(history_rows(spark, sf_dir), F.lit("1998-06-01 00:00:00").cast("timestamp"), "v1")
    return quality.check(stamped, [quality.not_before("_processed_time", "run_date")], "gold")


@query
def rule_foreign_key(spark, sf_dir):
    """Order lines against finished orders, and orders against customers."""
    orders = X.table(spark, sf_dir, "orders")
    done = orders.where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("run_id"))
    steps = X.etl_steps(spark, sf_dir)
    report = quality.check_reference(steps, done, ["run_id"], "etl_pipeline_steps")
    customers = X.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"))
    return report.unionByName(quality.check_reference(orders, customers, ["o_custkey"], "orders"))


@query
def ml_critical_checks(spark, sf_dir):
    return quality.check(window_gold(spark, sf_dir), rules.ml_critical_rules(), "dataset")


@query
def ml_soft_checks(spark, sf_dir):
    return quality.check(window_gold(spark, sf_dir), rules.ml_soft_rules(), "dataset")


@query
def quality_report(spark, sf_dir):
    """Rules counted while a dirty batch and the window's rows are written, and what became of each batch."""
    home, told = scratch_path(spark, "warehouse"), []
    batches = [
        storage.Batch(dirty_silver(spark, sf_dir), f"{home}/silver", rules=tuple(rules.silver_rules(False)), layer="silver"),
        storage.Batch(window_gold(spark, sf_dir), f"{home}/dataset", rules=tuple(rules.ml_soft_rules()), layer="dataset"),
    ]
    for batch in batches:
        reports, refused = [], False
        try:
            storage.publish([batch], reports=reports)
        except quality.QualityError as error:
            reports, refused = error.report, True
        told += [(*row, refused) for row in reports]
    action = F.when(F.col("passed"), "pass").when(F.col("refused") & (F.col("severity") == quality.CRITICAL), "raise").otherwise("warn")
    return spark.createDataFrame(told, f"{quality.REPORT_DDL}, refused boolean").withColumn("action", action)


# ---- ledger --------------------------------------------------------------------------------------------------


@query
def upsert_update(spark, sf_dir):
    """Finished orders as known runs, the others as a rerun: new states and clears, kept ids and row counts."""
    target, source = X.ledger_halves(spark, sf_dir)
    reset = {"error_message": F.lit(None).cast("string"), "rows_gold": F.lit(0).cast("long")}
    return ledger.upsert(target, source, ["dag_id", "run_date"], ["status", "triggered_by"], reset)


@query
def upsert_ignore(spark, sf_dir):
    target, source = X.ledger_halves(spark, sf_dir)
    return ledger.insert_ignore(target, source, ["dag_id", "run_date"])


@query
def keyed_update(spark, sf_dir):
    """States of known runs replaced and stamped when they end, cleared when they run again; unknown runs are ignored."""
    target, source = X.ledger_halves(spark, sf_dir)
    kind = F.col("run_id") % 3
    state = F.when(kind == 0, "success").when(kind == 1, "failed").otherwise("running")
    changes = source.select("dag_id", "run_date", state.alias("status")).withColumn(
        "ended_at", ledger.terminal_stamp("status", clock())
    )
    ended = target.withColumn("ended_at", clock() - F.expr("INTERVAL 1 DAY"))
    return plain_time(ledger.update_by_key(ended, changes, ["dag_id", "run_date"]), "ended_at")


@query
def run_outcome(spark, sf_dir):
    return ledger.run_outcome(X.etl_steps(spark, sf_dir), runs_plan.STEPS)


@query
def step_metrics(spark, sf_dir):
    return ledger.step_metrics(X.etl_steps(spark, sf_dir), runs_plan.STEPS)


@query
def cascade_delete(spark, sf_dir):
    """The steps that stay when the runs of pending orders go."""
    removed = X.table(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("run_id"))
    return ledger.cascade_delete(X.etl_steps(spark, sf_dir), removed, ["run_id"]).select(
        "run_id", "step_name", "status", "input_rows", "output_rows"
    )


@query
def lineage_view(spark, sf_dir):
    runs, datasets, stages, metrics = X.lineage_tables(spark, sf_dir)
    return rounded(ledger.lineage(runs, datasets, stages, metrics))


# ---- datasets and models -------------------------------------------------------------------------------------


@query
def time_split(spark, sf_dir):
    return split_rows(spark, sf_dir).select("item_id", "store_id", "run_date", "split")


@query
def fingerprints(spark, sf_dir):
    """Dataset fingerprints for every run date, with that day's row count as the data part."""
    days = X.sales_daily(spark, sf_dir).groupBy("run_date").agg(F.count(F.lit(1)).alias("rows"))
    schema, feature = splits.schema_hash(S.MODEL_COLUMNS), splits.feature_hash("v1", splits.model_features())
    day = F.col("run_date")
    return days.select(
        "run_date", "rows", schema.alias("schema_hash"), feature.alias("feature_hash"),
        splits.build_id("demand_features", day, "v1", 1).alias("build_id"),
        splits.dataset_id("demand_features", day, 1, schema, feature, F.col("rows")).alias("dataset_id"),
    )


def _dataset(spark, sf_dir) -> tuple[PipelineConfig, dict]:
    """A published dataset from the stored gold table."""
    cfg = X.gold_store(spark, sf_dir)
    runs = spark.createDataFrame([(1, "success")], "run_id long, status string")
    return cfg, dataset_plan.build_dataset(spark, cfg, X.ML_RUN_DATE, 1, runs)


@query
def build_dataset(spark, sf_dir):
    """The registry row of a dataset built end to end (paths left out: they name the scratch folder)."""
    _, manifest = _dataset(spark, sf_dir)
    row = dataset_plan.manifest_row(spark, manifest, X.CLOCK)
    return row.drop("train_path", "val_path", "test_path", "created_at")


@query
def dataset_publish(spark, sf_dir):
    """The rows of the published split files."""
    _, manifest = _dataset(spark, sf_dir)
    rows = dataset_plan.read_split(spark, manifest["dataset_dir"])
    return rows.select(*[
        F.round(F.col(field.name).cast("double"), 3).alias(field.name) if field.dataType.typeName() == "float" else F.col(field.name)
        for field in rows.schema
    ])


@query
def dataset_libsvm(spark, sf_dir):
    """The learner files of the published dataset, read back by split."""
    _, manifest = _dataset(spark, sf_dir)
    names, out = manifest["features"], None
    for split in S.SPLITS:
        read = libsvm.read_libsvm(spark, f"{manifest['dataset_dir']}/libsvm/{split}", len(names))
        part = read.select(F.lit(split).alias("split"), "label", *_cells(read, names))
        out = part if out is None else out.unionByName(part)
    return out


@query
def content_fingerprint(spark, sf_dir):
    """Rows and content hash of every day of gold, from rows dealt anew; the hash does not depend on their order."""
    gold = gold_rows(spark, sf_dir).repartition(7)
    return splits.content_sums(gold, ["run_date"], ["_processed_time"])


def _learner_rows(spark, manifest: dict) -> tuple[DataFrame, DataFrame]:
    names, home = manifest["features"], manifest["dataset_dir"]
    return tuple(libsvm.read_libsvm(spark, f"{home}/libsvm/{split}", len(names)) for split in ("train", "val"))


def _trained(spark, sf_dir, rounds: int = training.MAX_ROUNDS):
    _, manifest = _dataset(spark, sf_dir)
    train, val = _learner_rows(spark, manifest)
    return manifest, manifest["features"], val, training.train_candidates(train, val, rounds)


@query
def train_candidates(spark, sf_dir):
    """Size and feature use of the fitted candidates."""
    _, names, val, models = _trained(spark, sf_dir)
    rows = [(name, model.getNumTrees, model.totalNumNodes, len(names)) for name, model in models.items()]
    return spark.createDataFrame(rows, "model string, trees int, nodes int, features int")


@query
def candidate_metrics(spark, sf_dir):
    _, names, val, models = _trained(spark, sf_dir)
    return training.candidate_metrics(models, val, names)


@query
def candidate_baseline(spark, sf_dir):
    """The baseline's row of the candidates' table, over the validation rows of the learner files."""
    _, manifest = _dataset(spark, sf_dir)
    _, val = _learner_rows(spark, manifest)
    return rounded(training.candidate_metrics({}, val, manifest["features"]))


def _predicted(spark, sf_dir, rounds: int) -> DataFrame:
    manifest, names, val, models = _trained(spark, sf_dir, rounds)
    home = scratch_path(spark, "models")
    training.save_models(spark, models, training.select_best(training.candidate_metrics(models, val, names)), home)
    _, model = training.load_best(spark, home)
    test = dataset_plan.feature_vectors(spark, manifest["dataset_dir"], "test", names)
    path = scratch_path(spark, "predictions")
    training.batch_predict(model, test).write.parquet(path)
    return spark.read.parquet(path)


@query
def batch_predict(spark, sf_dir):
    """The better candidate, saved and loaded again, over the test rows."""
    return _predicted(spark, sf_dir, training.MAX_ROUNDS)


@query
def batch_predict_rows(spark, sf_dir):
    """Everything but the prediction of a written prediction file, by the row's key; two rounds do for that."""
    return _predicted(spark, sf_dir, 2).select("item_id", "store_id", "dept_id", "run_date", "sales", "baseline_prediction")


# ---- whole runs ----------------------------------------------------------------------------------------------


_RUNS: dict[tuple[str, str, str], tuple[PipelineConfig, list[dt.date]]] = {}


def _loaded(spark, sf_dir) -> tuple[PipelineConfig, list[dt.date]]:
    """Raw files to gold for every day of the calendar in one backfill; once per session and state of the given tables."""
    key = (spark.sparkContext.applicationId, sf_dir, X.stamp(spark, sf_dir))
    if key not in _RUNS:
        _RUNS[key] = _load(spark, sf_dir)
    return _RUNS[key]


def _load(spark, sf_dir) -> tuple[PipelineConfig, list[dt.date]]:
    cfg = X.pipeline(spark, X.SHIFTED_BASE)
    sales, calendar, prices = X.write_raw_files(spark, sf_dir)
    days = sorted(row["date"] for row in csv.read_calendar(spark, calendar).select("date").collect())
    runs_plan.run_etl(spark, cfg, days, sales, calendar, prices)
    return cfg, days


@query
def etl_run(spark, sf_dir):
    """The ledger row of the run."""
    cfg, _ = _loaded(spark, sf_dir)
    return runs_plan.Ledger(spark, cfg).etl_runs().select(
        "run_id", "dag_id", "run_date", "status", "error_message", "rows_bronze", "rows_silver", "rows_gold"
    )


@query
def etl_run_tables(spark, sf_dir):
    """What the run has published: rows and content of bronze, silver and gold on every day."""
    cfg, _ = _loaded(spark, sf_dir)
    at = runs_plan.Ledger(spark, cfg).snapshot()
    out = None
    for name, schema in ((bronze_plan.BRONZE, S.BRONZE_SCHEMA), (gold_plan.SILVER, S.SILVER_SCHEMA), (gold_plan.GOLD, S.GOLD_SCHEMA)):
        table = tables.read_table(spark, cfg.table(name), schema, at)
        part = splits.content_sums(table, ["run_date"], ["_processed_time"]).withColumn("layer", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


@query
def ml_run(spark, sf_dir):
    """Raw files to metrics: the lineage of the run with the stored metrics that need no model to check."""
    cfg, days = _loaded(spark, sf_dir)
    runs_plan.run_ml(spark, cfg, max(days))
    view = runs_plan.Ledger(spark, cfg).lineage(metrics=True)
    known = ["prediction_rows", "rows", "baseline_rmse", "baseline_mae", "baseline_wmape"]
    return rounded(view.where(F.col("metric").isin(known)).select(
        "run_id", "pipeline_name", "run_date", "run_status", "total_row_count", "stage", "stage_status", "metric", "slice", "value"
    ), 5)
