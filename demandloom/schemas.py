"""Column lists and table schemas of every layer."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names, their order and the key of each table.
SALES_IDS = ["item_id", "dept_id", "cat_id", "store_id", "state_id"]
SERIES_KEY = ["item_id", "store_id"]
SNAP_COLUMNS = ["snap_ca", "snap_tx", "snap_wi"]
EVENT_COLUMNS = ["event_name_1", "event_type_1", "event_name_2", "event_type_2"]
EVENT_TYPE_COLUMNS = ["event_type_1", "event_type_2"]
LAGS = (1, 3, 7, 14, 28)
WINDOWS = (7, 14, 28)
LAG_COLUMNS = [f"sales_lag_{k}" for k in LAGS]
MEAN_COLUMNS = [f"sales_roll_mean_{n}" for n in WINDOWS]
STD_COLUMNS = [f"sales_roll_std_{n}" for n in WINDOWS]
COLD_START_DAYS = 28

BRONZE_COLUMNS = [
    "item_id", "store_id", "dept_id", "cat_id", "state_id", "d", "sales", "run_date", "_pipeline_version",
]
CALENDAR_COLUMNS = [
    "d", "date", "wm_yr_wk", "weekday", "wday", "month", "year", *EVENT_COLUMNS, *SNAP_COLUMNS,
]
PRICE_COLUMNS = ["store_id", "item_id", "wm_yr_wk", "sell_price"]
SILVER_COLUMNS = [
    "run_date", "_processed_time", "_pipeline_version", "store_id", "item_id", "d", "date", "dept_id", "cat_id",
    "state_id", "sales", "sell_price", "wm_yr_wk", "weekday", "wday", "month", "year", *EVENT_COLUMNS, *SNAP_COLUMNS,
]
GOLD_COLUMNS = [
    "item_id", "store_id", "dept_id", "cat_id", "state_id", "d", "sales", "sell_price", "run_date",
    "_processed_time", "_pipeline_version", "wday", "weekday", "month", "year", "wm_yr_wk", *LAG_COLUMNS,
    "sales_roll_mean_7", "sales_roll_std_7", "sales_roll_mean_14", "sales_roll_std_14", "sales_roll_mean_28",
    "sales_roll_std_28", "is_weekend", "quarter", *EVENT_COLUMNS, *SNAP_COLUMNS, "is_cold_start",
]
MODEL_COLUMNS = [
    "item_id", "store_id", "dept_id", "cat_id", "state_id", "d", "sales", "sell_price", "run_date",
    "_processed_time", "_pipeline_version", *LAG_COLUMNS, *MEAN_COLUMNS, *STD_COLUMNS, "is_cold_start",
    "is_weekend", "quarter", "month", "wday", "weekday", "year", *EVENT_COLUMNS, *SNAP_COLUMNS, "wm_yr_wk",
]
CATEGORICAL_COLUMNS = ["item_id", "store_id", "dept_id", "cat_id", "state_id", *EVENT_COLUMNS]
UNUSED_MODEL_COLUMNS = ["d", "_pipeline_version", "_processed_time", "weekday"]
FLOAT_MODEL_COLUMNS = ["sales", "sell_price", *MEAN_COLUMNS, *STD_COLUMNS]
TARGET = "sales"
DATE_COLUMN = "run_date"
SPLIT_COLUMN = "split"
SPLITS = ("train", "val", "test")
SCORED_COLUMNS = ["prediction", "baseline_prediction", "sales", "store_id", "dept_id"]
PREDICTION_COLUMNS = [*SCORED_COLUMNS, "item_id", "run_date"]

BRONZE_KEY = ["item_id", "store_id", "run_date"]
PRICE_KEY = ["store_id", "item_id", "wm_yr_wk"]
CALENDAR_KEY = ["d"]
SILVER_KEY = ["store_id", "item_id", "d"]
GOLD_KEY = ["item_id", "store_id", "d", "run_date"]
RUN_STATES = ("running", "success", "failed")
STEP_STATES = ("running", "success", "failed", "skipped")

_TEXT, _INT, _LONG, _DOUBLE = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
_DATE, _TIME, _FLAG = T.DateType(), T.TimestampType(), T.BooleanType()

_TYPES = {
    **{name: _TEXT for name in [*SALES_IDS, "d", "_pipeline_version", "weekday", *EVENT_COLUMNS]},
    **{name: _INT for name in ["sales", "wm_yr_wk", "wday", "month", "year", *SNAP_COLUMNS, *LAG_COLUMNS]},
    **{name: _DOUBLE for name in ["sell_price", *MEAN_COLUMNS, *STD_COLUMNS]},
    "is_weekend": _INT, "quarter": _INT, "is_cold_start": _FLAG,
    "run_date": _DATE, "date": _DATE, "_processed_time": _TIME,
}


def schema_of(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(name, _TYPES[name], True) for name in columns])


BRONZE_SCHEMA = schema_of(BRONZE_COLUMNS)
CALENDAR_SCHEMA = schema_of(CALENDAR_COLUMNS)
PRICE_SCHEMA = schema_of(PRICE_COLUMNS)
SILVER_SCHEMA = schema_of(SILVER_COLUMNS)
GOLD_SCHEMA = schema_of(GOLD_COLUMNS)


def _struct(fields: dict[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


ETL_RUN_SCHEMA = _struct({
    "run_id": _LONG, "dag_id": _TEXT, "pipeline_name": _TEXT, "run_date": _DATE, "status": _TEXT,
    "triggered_by": _TEXT, "started_at": _TIME, "ended_at": _TIME, "error_message": _TEXT, "rows_bronze": _LONG,
    "rows_silver": _LONG, "rows_gold": _LONG, "created_at": _TIME,
})
ETL_STEP_SCHEMA = _struct({
    "step_run_id": _LONG, "run_id": _LONG, "dag_id": _TEXT, "step_name": _TEXT, "status": _TEXT,
    "started_at": _TIME, "ended_at": _TIME, "input_rows": _LONG, "output_rows": _LONG, "error_message": _TEXT,
})
ML_RUN_SCHEMA = _struct({
    "run_id": _TEXT, "pipeline_name": _TEXT, "run_date": _DATE, "status": _TEXT, "triggered_by": _TEXT,
    "created_at": _TIME, "ended_at": _TIME, "error_message": _TEXT,
})
DATASET_SCHEMA = _struct({
    "dataset_id": _TEXT, "run_id": _TEXT, "pipeline_name": _TEXT, "source_table": _TEXT,
    "dataset_start_date": _DATE, "dataset_end_date": _DATE, "train_path": _TEXT, "val_path": _TEXT,
    "test_path": _TEXT, "train_row_count": _LONG, "val_row_count": _LONG, "test_row_count": _LONG,
    "total_row_count": _LONG, "feature_version": _TEXT, "feature_hash": _TEXT, "schema_hash": _TEXT,
    "content_hash": _TEXT, "created_at": _TIME,
})
ML_STAGE_SCHEMA = _struct({
    "ml_run_id": _TEXT, "run_id": _TEXT, "dataset_id": _TEXT, "stage": _TEXT, "status": _TEXT,
    "tracking_id": _TEXT, "source_tracking_id": _TEXT, "created_at": _TIME, "ended_at": _TIME,
    "error_message": _TEXT,
})
METRIC_SCHEMA = _struct({
    "run_id": _TEXT, "dataset_id": _TEXT, "stage": _TEXT, "metric": _TEXT, "slice": _TEXT, "value": _DOUBLE,
    "ml_run_id": _TEXT,
})
ETL_RUN_KEY = ["pipeline_name", "dag_id", "run_date"]
ETL_STEP_KEY = ["run_id", "dag_id", "step_name"]
ML_RUN_KEY = ["run_id"]
DATASET_KEY = ["dataset_id"]
ML_STAGE_KEY = ["run_id", "dataset_id", "stage"]
