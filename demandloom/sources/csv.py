"""The three raw CSV files.

Schemas are declared, never inferred: everything is read as text and parsed by safe casts, so one bad cell
cannot fail a job or change a column's type. The CSV reader parses only the columns a plan selects.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandloom.functions.scalars import day_date, day_label, null_default, safe_double, safe_int
from demandloom.operators.dedup import file_position, keep_first, with_file_order
from demandloom.schemas import BRONZE_COLUMNS, CALENDAR_COLUMNS, PRICE_COLUMNS, SALES_IDS, SERIES_KEY, SNAP_COLUMNS


def read_text_csv(spark: SparkSession, path: str) -> DataFrame:
    """A headed CSV with every column as text; the header is read from the first line only."""
    header = spark.read.option("header", True).option("inferSchema", False).csv(path).columns
    schema = T.StructType([T.StructField(name, T.StringType(), True) for name in header])
    return spark.read.schema(schema).option("header", True).csv(path)


def require_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def read_wide_sales(
    spark: SparkSession,
    path: str,
    base: dt.date,
    days: Sequence[dt.date] | None = None,
    version: str = "v1",
) -> DataFrame:
    """Bronze rows of the wide sales file for some days (all of its days by default).

    The day cells of a line travel as one array, so the plan stays small however many days the file has. Repeated
    series lines are dropped before the days are unfolded: a line repeats in all its days at once, so keeping the
    first line per series equals keeping the first row per series and day, and the shuffle carries one row per line.
    """
    wide = read_text_csv(spark, path)
    if days is None:
        labels = [name for name in wide.columns if name.startswith("d_")]
    else:
        labels = [day_label(day, base) for day in days]
    require_columns(wide, [*SALES_IDS, *labels])
    cells = F.expr(f"array({', '.join(f'`{name}`' for name in labels)})")
    lines = with_file_order(wide.select(*SALES_IDS, cells.alias("cells"), file_position().alias("_file")))
    lines = keep_first(lines, SERIES_KEY, "_order")
    long = lines.select(*SALES_IDS, F.posexplode("cells").alias("place", "sales"))
    names = F.split(F.lit(",".join(labels)), ",")
    return bronze_rows(long.withColumn("d", names[F.col("place")]), day_date("d", base), version)


def bronze_rows(long: DataFrame, run_date: Column, version: str) -> DataFrame:
    """Parse the sales cell, stamp date and version, and put the columns in table order."""
    return long.select(
        *SALES_IDS, "d", safe_int("sales").alias("sales"), run_date.alias("run_date"),
        F.lit(version).alias("_pipeline_version"),
    ).select(*BRONZE_COLUMNS)


def read_calendar(spark: SparkSession, path: str) -> DataFrame:
    """The calendar file: lower-case headers, 14 columns, a missing snap flag is 0."""
    raw = read_text_csv(spark, path)
    raw = require_columns(raw.toDF(*[name.lower() for name in raw.columns]), CALENDAR_COLUMNS)
    whole = ["wm_yr_wk", "wday", "month", "year"]
    parsed = {name: safe_double(name).try_cast("int") for name in whole}
    parsed |= {name: null_default(safe_double(name).try_cast("int")) for name in SNAP_COLUMNS}
    parsed["date"] = F.col("date").try_cast("date")
    return raw.select(*[parsed.get(name, F.col(name)).alias(name) for name in CALENDAR_COLUMNS])


def read_prices(spark: SparkSession, path: str) -> DataFrame:
    """The price file: 4 columns, a malformed price is null."""
    raw = require_columns(read_text_csv(spark, path), PRICE_COLUMNS)
    return raw.select(
        "store_id", "item_id", F.col("wm_yr_wk").try_cast("int").alias("wm_yr_wk"),
        F.round(safe_double("sell_price"), 4).alias("sell_price"),
    )
