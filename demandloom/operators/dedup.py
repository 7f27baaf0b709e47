"""Keep-first de-duplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def file_position() -> Column:
    """File and block offset of a row; select it right on the scan of a file source."""
    return F.struct(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start")
    )


def with_file_order(scan: DataFrame, origin: str = "_file", order: str = "_order") -> DataFrame:
    """Add the position of each row in its files.

    Must sit right on the scan: ids grow along a task, a task reads each block from its start, and blocks are
    ordered by file and offset, so the triple repeats exactly when a lost task runs again.
    """
    position = F.struct(
        F.col(origin)["path"].alias("path"), F.col(origin)["start"].alias("start"),
        F.monotonically_increasing_id().alias("row"),
    )
    return scan.withColumn(order, position).drop(origin)


def keep_first(df: DataFrame, keys: Sequence[str], order: str | Column) -> DataFrame:
    """One row per key: the one that comes first in ``order``.

    A minimum is combined before the shuffle, so a key that holds a large share of the rows leaves each task as
    one row; ranking the rows of a key would send all of them to one task.
    """
    rank = F.col(order) if isinstance(order, str) else order
    rest = [name for name in df.columns if name not in keys]
    first = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), rank).alias("_first"))
    picked = [F.col(name) if name in keys else F.col("_first")[name].alias(name) for name in df.columns]
    return first.select(*picked)
