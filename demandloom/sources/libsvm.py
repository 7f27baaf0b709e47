"""Sparse learner files: label and 1-based ``index:value`` pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_libsvm(spark: SparkSession, path: str, features: int) -> DataFrame:
    """Columns ``label`` and ``features``; the width is given, so the file is not scanned to find it."""
    return spark.read.format("libsvm").option("numFeatures", str(features)).load(path)


def write_libsvm(vectors: DataFrame, path: str, label: str = "label", features: str = "features") -> None:
    vectors.select(F.col(label).cast("double").alias("label"), F.col(features).alias("features")).write.format(
        "libsvm"
    ).save(path)
