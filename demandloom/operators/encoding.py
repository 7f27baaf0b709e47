"""Ordinal codes of the categorical columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandloom.schemas import CATEGORICAL_COLUMNS
from demandloom.session import ensure_checkpoint_dir


def distinct_values(df: DataFrame, columns: Sequence[str] = CATEGORICAL_COLUMNS) -> DataFrame:
    """Distinct non-null values of all columns in one scan: ``(column, value)``.

    Values are made distinct inside each task before the shuffle, so a value that fills a third of the rows
    travels once per task.
    """
    cells = df.select(*[F.col(name).cast("string").alias(name) for name in columns])
    return cells.unpivot([], list(columns), "column", "value").where(F.col("value").isNotNull()).distinct()


def fit_vocabulary(df: DataFrame, columns: Sequence[str] = CATEGORICAL_COLUMNS) -> DataFrame:
    """``(column, value, code)``: codes 0..n-1 in value order within each column.

    The rank is worked out without sending a column's values to one task: the distinct values are range-sorted
    over tasks and pinned by a checkpoint, each range is numbered on its own, and a range starts where the ones
    before it end (one small row per range and column).
    """
    ensure_checkpoint_dir(df.sparkSession)
    ranged = (
        distinct_values(df, columns).orderBy("column", "value")
        .withColumn("range", F.spark_partition_id()).checkpoint()
    )
    sizes = ranged.groupBy("column", "range").agg(F.count(F.lit(1)).alias("size"))
    before = Window.partitionBy("column").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("column", "range", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("column", "range").orderBy("value")
    numbered = ranged.withColumn("position", F.row_number().over(within) - 1)
    return numbered.join(starts, ["column", "range"]).select(
        "column", "value", (F.col("start") + F.col("position")).cast("int").alias("code")
    )


def unknown_codes(vocabulary: DataFrame) -> dict[str, int]:
    """The code of unseen values per column: one more than the largest (one row per column on the driver)."""
    rows = vocabulary.groupBy("column").agg(F.count(F.lit(1)).alias("size")).collect()
    return {row["column"]: row["size"] for row in rows}


def encode(df: DataFrame, vocabulary: DataFrame, columns: Sequence[str] = CATEGORICAL_COLUMNS) -> DataFrame:
    """Replace each categorical column by its code; null and unseen values take the unknown code.

    The lookups are plain left joins: Catalyst broadcasts the small ones by their size and shuffles a large one,
    where AQE splits a hot value.
    """
    unknown = unknown_codes(vocabulary)
    encoded = df
    for name in columns:
        if name not in df.columns:
            continue
        lookup = vocabulary.where(F.col("column") == name).select(
            F.col("value").alias(name), F.col("code").alias(f"_{name}_code")
        )
        encoded = encoded.join(lookup, name, "left").withColumn(
            name, F.coalesce(F.col(f"_{name}_code"), F.lit(unknown.get(name, 0))).cast("int")
        ).drop(f"_{name}_code")
    return encoded.select(*df.columns)
