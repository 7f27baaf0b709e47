"""Names for documents whose id is not theirs alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.llm.storage import written

HOLDER = "__holder"


def with_holders(docs: DataFrame) -> tuple[DataFrame, bool]:
    """``docs`` with a number per document, and whether it differs from ``doc_id`` anywhere.

    It is the ``doc_id``; where one has several texts, all but the one with the smallest hash get a number of their own, a
    64-bit hash of id and text.
    """
    key = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    own = F.col("doc_id").cast("bigint")
    several = docs.select(own.alias("__id"), key.alias("__key")).where("__id is not null").groupBy("__id").agg(
        F.min("__key").alias("__low"), F.max("__key").alias("__high")).where("__low <> __high")
    if several.isEmpty():
        return docs.withColumn(HOLDER, own), False
    held = written(several.select("__id", "__low"), "holders")
    joined = docs.join(held, own == F.col("__id"), "left")
    other = F.col("__low").isNotNull() & (key != F.col("__low"))
    return joined.withColumn(HOLDER, F.when(other, F.xxhash64(own, key)).otherwise(own)).drop("__id", "__low"), True
