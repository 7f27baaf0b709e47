"""Trailing window, time split, model columns and fingerprints of a dataset."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandloom.config import TRAILING_DAYS, TRAIN_SHARE, VALIDATION_SHARE
from demandloom.functions.scalars import fingerprint
from demandloom.schemas import (
    DATE_COLUMN, FLOAT_MODEL_COLUMNS, MODEL_COLUMNS, SPLIT_COLUMN, TARGET, UNUSED_MODEL_COLUMNS,
)


def trailing_window(end: dt.date, base: dt.date, days: int = TRAILING_DAYS) -> tuple[dt.date, dt.date]:
    """First and last day of the dataset: at most ``days`` back and never before the base date."""
    return max(end - dt.timedelta(days=days), base), end


def split_bounds(
    start: dt.date, end: dt.date, train: float = TRAIN_SHARE, validation: float = VALIDATION_SHARE
) -> tuple[dt.date, dt.date]:
    """Last day of the training rows and last day of the validation rows."""
    total = (end - start).days
    return start + dt.timedelta(days=int(total * train)), start + dt.timedelta(days=int(total * validation))


def add_window_bounds(
    days: DataFrame, base: dt.date, end: str = DATE_COLUMN, train: float = TRAIN_SHARE,
    validation: float = VALIDATION_SHARE,
) -> DataFrame:
    """Window start and split bounds as columns, for a whole table of run dates."""
    start = F.greatest(F.date_sub(end, TRAILING_DAYS), F.lit(base))
    total = F.datediff(end, "window_start")
    return days.withColumn("window_start", start).withColumns({
        "train_end": F.date_add("window_start", F.floor(total * F.lit(train)).cast("int")),
        "val_end": F.date_add("window_start", F.floor(total * F.lit(validation)).cast("int")),
    })


def split_label(day: str, train_end: dt.date, val_end: dt.date) -> Column:
    return (
        F.when(F.col(day) <= F.lit(train_end), "train").when(F.col(day) <= F.lit(val_end), "val").otherwise("test")
    )


def time_split(
    df: DataFrame,
    start: dt.date,
    end: dt.date,
    date_column: str = DATE_COLUMN,
    train: float = TRAIN_SHARE,
    validation: float = VALIDATION_SHARE,
) -> DataFrame:
    """The rows of the window with their split; disjoint and ordered in time."""
    train_end, val_end = split_bounds(start, end, train, validation)
    window = df.where(F.col(date_column).between(F.lit(start), F.lit(end)))
    return window.withColumn(SPLIT_COLUMN, split_label(date_column, train_end, val_end))


def narrow(df: DataFrame, drop: list[str] | None = None) -> DataFrame:
    """Whole numbers to int, fractions to float, booleans to byte; columns no model uses are dropped."""
    dropped = UNUSED_MODEL_COLUMNS if drop is None else drop
    columns = []
    for field in df.schema:
        if field.name in dropped:
            continue
        kind, column = field.dataType, F.col(field.name)
        if field.name in FLOAT_MODEL_COLUMNS or isinstance(kind, (T.FractionalType, T.DecimalType)):
            column = column.cast("float")
        elif isinstance(kind, T.IntegralType):
            column = column.cast("int")
        elif isinstance(kind, T.BooleanType):
            column = column.cast("byte")
        elif field.name == DATE_COLUMN and not isinstance(kind, T.DateType):
            column = column.try_cast("date")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def feature_columns(columns: list[str]) -> list[str]:
    """Every column that is neither target, date nor split, in the given order."""
    return [name for name in columns if name not in {TARGET, DATE_COLUMN, SPLIT_COLUMN}]


def model_features() -> list[str]:
    return feature_columns([name for name in MODEL_COLUMNS if name not in UNUSED_MODEL_COLUMNS])


def split_counts(df: DataFrame) -> DataFrame:
    """Rows per split."""
    return df.groupBy(SPLIT_COLUMN).agg(F.count(F.lit(1)).alias("rows"))


def named(**parts) -> list[Column]:
    """``name=value`` parts for a fingerprint."""
    columns = []
    for name, value in parts.items():
        column = value if isinstance(value, Column) else F.lit(str(value))
        columns.append(F.concat(F.lit(f"{name}="), column.cast("string")))
    return columns


# Two primes under 2**61 and 2**59, and what separates cells and stands for null.
CONTENT_MODULI = (2305843009213693951, 576460752303423433)
CELL_END, NO_VALUE = "\x1f", "\x1e"


def row_text(schema: T.StructType) -> Column:
    """A row as text that other engines can repeat: fractions in whole ten-thousandths, everything else as it is printed."""
    cells = []
    for field in sorted(schema, key=lambda f: f.name):
        value = F.col(field.name)
        if isinstance(field.dataType, (T.FloatType, T.DoubleType, T.DecimalType)):
            value = F.round(value.cast("double") * 10000).cast("bigint")
        cells.append(F.coalesce(value.cast("string"), F.lit(NO_VALUE)))
    return F.concat_ws(CELL_END, *cells)


def content_sums(df: DataFrame, by: Sequence[str] = (), skip: Sequence[str] = ()) -> DataFrame:
    """``rows`` and ``content_hash`` of a multiset of rows, per value of ``by``; equal in any order of the rows.

    Two 60-bit pieces of each row's MD5 are summed up, one modulo each prime. Sums are combined inside the tasks, so the
    shuffle carries a row per task and group.
    """
    schema = T.StructType([field for field in df.schema if field.name not in skip])
    digest = F.md5(row_text(schema))
    pieces = [F.conv(F.substring(digest, start, 15), 16, 10).cast("decimal(20,0)") for start in (1, 16)]
    keyed = df.select(*by, pieces[0].alias("_a"), pieces[1].alias("_b"))
    sums = [
        F.coalesce((F.sum(name) % F.lit(prime).cast("decimal(20,0)")).cast("decimal(20,0)").cast("string"), F.lit("0"))
        for name, prime in zip(("_a", "_b"), CONTENT_MODULI)
    ]
    return keyed.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"), F.concat_ws("-", *sums).alias("content_hash"))


def schema_hash(columns: list[str]) -> Column:
    return fingerprint(named(columns=",".join(columns)))


def feature_hash(version: str, features: list[str]) -> Column:
    return fingerprint(named(feature_version=version, features=",".join(features)))


def build_id(pipeline: str, run_date: dt.date, version: str, run_id) -> Column:
    return fingerprint(named(pipeline_name=pipeline, run_date=run_date, feature_version=version, run_id=run_id))


def dataset_id(pipeline: str, run_date: dt.date, run_id, schema: Column, features: Column, rows: Column) -> Column:
    """The row count is the only part that depends on the data."""
    return fingerprint(
        named(
            pipeline_name=pipeline, run_date=run_date, etl_run_id=run_id, schema_hash=schema, feature_hash=features,
            row_count=rows,
        )
    )
