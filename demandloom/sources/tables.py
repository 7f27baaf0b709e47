"""Scans of the date-partitioned layer tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandloom.operators.storage import BATCH, Snapshot, folder_names, listed, snapshot_of
from demandloom.schemas import DATE_COLUMN
from demandloom.sources.csv import require_columns


def read_table(
    spark: SparkSession, path: str, schema: T.StructType | None = None, at: Snapshot | None = None
) -> DataFrame:
    """A published table as of a snapshot (the newest if not given), or a plain Parquet folder.

    A declared schema saves the footer read that inference needs. The rows stay those of the snapshot, whatever is
    published while they are read.
    """
    state = (at or snapshot_of(spark, path)).table(path)
    reader = spark.read if schema is None else spark.read.schema(schema)
    if state is None:
        table = listed(spark, lambda: reader.parquet(path))
        return table if schema is None else table.select(*schema.names)
    folders = state.folders(path)
    if not folders:
        return spark.createDataFrame([], schema)
    if state.partition is None:
        table = reader.parquet(*folders)
    else:
        table = listed(spark, lambda: reader.option("basePath", path).parquet(*folders).drop(BATCH))
    return table if schema is None else table.select(*schema.names)


def read_days(
    spark: SparkSession, path: str, schema: T.StructType, days: Sequence[dt.date], at: Snapshot | None = None
) -> DataFrame:
    """Some days of a date-partitioned table, given by folder: the folders of all other days are not even listed.

    Opening the whole table would list every file of every day before a filter prunes them. A plain Parquet folder is one
    of ``run_date`` folders.
    """
    state = (at or snapshot_of(spark, path)).table(path)
    if state:
        folders = state.folders(path, [day.isoformat() for day in days])
    else:
        wanted = {f"{DATE_COLUMN}={day.isoformat()}" for day in days}
        folders = [f"{path}/{name}" for name in sorted(wanted.intersection(folder_names(spark, path)))]
    if not folders:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema).option("basePath", path)
    return listed(spark, lambda: reader.parquet(*folders)).select(*schema.names)


def scan_partition(table: DataFrame, day: dt.date, column: str = DATE_COLUMN) -> DataFrame:
    return table.where(F.col(column) == F.lit(day))


def scan_partitions(table: DataFrame, days: Sequence[dt.date], column: str = DATE_COLUMN) -> DataFrame:
    """Some days; a gapless run of days is asked for as a range, which keeps the filter short."""
    first, last = min(days), max(days)
    if len(set(days)) == (last - first).days + 1:
        return scan_between(table, first, last, column)
    return table.where(F.col(column).isin([F.lit(day) for day in sorted(set(days))]))


def scan_history(table: DataFrame, day: dt.date, column: str = DATE_COLUMN) -> DataFrame:
    return table.where(F.col(column) <= F.lit(day))


def scan_between(table: DataFrame, first: dt.date, last: dt.date, column: str = DATE_COLUMN) -> DataFrame:
    """Both ends included."""
    return table.where(F.col(column).between(F.lit(first), F.lit(last)))


def scan_columns(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame:
    """Only the named columns of a Parquet file set; raises when one is missing."""
    return require_columns(spark.read.parquet(path), names).select(*names)


def row_count(table: DataFrame, day: dt.date | None = None, column: str = DATE_COLUMN) -> DataFrame:
    """One row ``rows``; with a day only that partition is counted."""
    chosen = table if day is None else scan_partition(table, day, column)
    return chosen.agg(F.count(F.lit(1)).alias("rows"))
