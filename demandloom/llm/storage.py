"""Written tables between the steps of an operator, and set membership of a fixed size."""

from __future__ import annotations

from weakref import WeakKeyDictionary

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom.operators.storage import delete
from demandloom.session import scratch_path

BITMAP_BITS = 15  # Spark's bitmap functions work on buckets of 2**15 bits
_FOLDERS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read again: lineage ends here and survives lost executors.

    The shuffle files of the job that writes go when it ends, not when the driver next collects garbage.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
    table = spark.read.schema(df.schema).parquet(path)
    _FOLDERS[table] = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete tables made by ``written`` once everything read from them has been written itself."""
    for table in tables:
        delete(table.sparkSession, _FOLDERS.pop(table))


def membership(keys: DataFrame, column: str, bits: int = 24) -> tuple[np.ndarray, np.ndarray]:
    """Two Bloom bitmaps of ``2**bits`` bits over a column of 64-bit hashes.

    Built by Spark as fixed blocks of 4 KB; the driver receives ``2**(bits - 15)`` of them per bitmap at most (2 MB each
    at 24 bits), however many keys there are. More keys only let more rows pass; users check exactly afterwards.
    """
    maps = []
    hashed = keys.select(F.col(column).cast("bigint").alias("key")).where(F.col("key").isNotNull())
    both = hashed.select(F.explode(F.array(*[
        F.struct(F.lit(which).alias("which"), slot_of(F.col("key"), which, bits).alias("slot")) for which in (0, 1)
    ])).alias("s")).select("s.*")
    blocks = both.groupBy("which", F.shiftright("slot", BITMAP_BITS).alias("block")).agg(
        F.expr(f"bitmap_construct_agg(slot & {(1 << BITMAP_BITS) - 1})").alias("bits")
    )
    found = blocks.collect()
    for which in (0, 1):
        bitmap = np.zeros(1 << (bits - 3), np.uint8)
        for row in found:
            if row["which"] == which:
                start = row["block"] << (BITMAP_BITS - 3)
                bitmap[start : start + (1 << (BITMAP_BITS - 3))] = np.frombuffer(bytes(row["bits"]), np.uint8)
        maps.append(bitmap)
    return maps[0], maps[1]


def slot_of(key: Column, which: int, bits: int) -> Column:
    """The low bits, or the bits above them, of a key that is a hash already."""
    return F.shiftrightunsigned(key, which * bits).bitwiseAND(F.lit((1 << bits) - 1))


def in_membership(values: np.ndarray, maps: tuple[np.ndarray, np.ndarray], bits: int = 24) -> np.ndarray:
    """Which of the signed or unsigned 64-bit hashes may be members."""
    keys, mask = values.view(np.uint64), np.uint64((1 << bits) - 1)
    found = np.ones(len(keys), bool)
    for which, bitmap in enumerate(maps):
        slot = (keys >> np.uint64(which * bits)) & mask
        found &= (bitmap[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & np.uint8(1) == 1
    return found
