"""Quality rules over a batch.

A rule is an aggregate that counts violations, so all rules of a layer run in one pass and only one row per
rule reaches the driver. While a batch is written they are counted by the write itself (``observed``). Uniqueness needs a
second pass, a grouped count that is combined before its shuffle; after a write it reads the written key columns only.
"""

from __future__ import annotations

import logging
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

logger = logging.getLogger(__name__)
CRITICAL, SOFT = "critical", "soft"


class QualityError(ValueError):
    """A critical rule failed; ``report`` holds the rows of all rules checked with it."""

    def __init__(self, message: str, report: list | None = None) -> None:
        super().__init__(message)
        self.report = report or []


class EmptyBatch(QualityError):
    """A batch without rows must not replace anything."""


@dataclass(frozen=True)
class Rule:
    name: str
    failed: Column
    severity: str = CRITICAL


@dataclass(frozen=True)
class UniqueKey:
    """No key occurs twice; ``failed_rows`` counts the keys that do."""

    keys: tuple[str, ...]
    severity: str = CRITICAL

    @property
    def name(self) -> str:
        return f"unique({','.join(self.keys)})"


def every_row(name: str, holds: Column, severity: str = CRITICAL) -> Rule:
    """A row fails when the condition is false or null."""
    return Rule(name, F.count_if(~F.coalesce(holds, F.lit(False))), severity)


def batch(name: str, holds: Column, severity: str = CRITICAL) -> Rule:
    """A condition over aggregates; counts one failure when it is false or null."""
    return Rule(name, F.when(holds, 0).otherwise(1), severity)


def not_null(column: str) -> Rule:
    return every_row(f"not_null({column})", F.col(column).isNotNull())


def at_least(column: str, bound: float) -> Rule:
    return every_row(f"at_least({column},{bound})", F.col(column).isNull() | (F.col(column) >= bound))


def in_range(column: str, low: float, high: float) -> Rule:
    return every_row(f"in_range({column},{low},{high})", F.col(column).isNull() | F.col(column).between(low, high))


def one_of(column: str, values: Sequence, nullable: bool = False) -> Rule:
    known = F.col(column).isin(*values)
    label = f"one_of({column})" if not nullable else f"one_of_or_null({column})"
    return every_row(label, (F.col(column).isNull() | known) if nullable else known)


def not_before(column: str, other: str) -> Rule:
    return every_row(f"not_before({column},{other})", F.col(column) >= F.col(other))


def single_value(column: str) -> Rule:
    """One distinct non-null value: the smallest equals the largest, which needs no distinct count."""
    return batch(f"single_value({column})", F.min(column) == F.max(column))


REPORT_DDL = "layer string, rule string, severity string, failed_rows long, total_rows long, passed boolean"
REPORT_COLUMNS = ["layer", "rule", "severity", "failed_rows", "total_rows", "passed"]


def _report_row(layer: str, name: str, severity: str, failed: Column, total: Column) -> Column:
    return F.struct(
        F.lit(layer).alias("layer"), F.lit(name).alias("rule"), F.lit(severity).alias("severity"),
        failed.alias("failed_rows"), total.alias("total_rows"), (failed == 0).alias("passed"),
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def _failed(rules: Iterable[Rule]) -> list[Column]:
    return [F.coalesce(rule.failed.cast("long"), F.lit(0)).alias(f"failed_{i}") for i, rule in enumerate(rules)]


def observed(rules: Iterable[Rule | UniqueKey]) -> list[Column]:
    """The counts of all rules but unique keys, for ``DataFrame.observe``; none without such rules."""
    plain = [rule for rule in rules if isinstance(rule, Rule)]
    return [F.count(F.lit(1)).alias("total"), *_failed(plain)] if plain else []


def observed_report(spark: SparkSession, rules: Iterable[Rule | UniqueKey], layer: str, counts: Mapping[str, int]) -> DataFrame:
    """The report of the rules whose ``observed`` counts a job has brought back."""
    plain = [rule for rule in rules if isinstance(rule, Rule)]
    rows = [
        (layer, rule.name, rule.severity, counts[f"failed_{i}"], counts["total"], counts[f"failed_{i}"] == 0)
        for i, rule in enumerate(plain)
    ]
    return spark.createDataFrame(rows, REPORT_DDL)


def check(df: DataFrame, rules: Iterable[Rule | UniqueKey], layer: str) -> DataFrame:
    """One report row per rule."""
    rules = list(rules)
    plain = [rule for rule in rules if isinstance(rule, Rule)]
    reports = []
    if plain:
        counted = df.agg(
            F.count(F.lit(1)).alias("total"), *_failed(plain),
        )
        rows = [
            _report_row(layer, rule.name, rule.severity, F.col(f"failed_{i}"), F.col("total"))
            for i, rule in enumerate(plain)
        ]
        reports.append(counted.select(F.inline(F.array(*rows))))
    for rule in rules:
        if isinstance(rule, UniqueKey):
            groups = df.groupBy(*rule.keys).agg(F.count(F.lit(1)).alias("rows"))
            counted = groups.agg(
                F.count_if(F.col("rows") > 1).alias("failed"), F.coalesce(F.sum("rows"), F.lit(0)).alias("total")
            )
            row = _report_row(layer, rule.name, rule.severity, F.col("failed"), F.col("total"))
            reports.append(counted.select(F.inline(F.array(row))))
    return reduce(DataFrame.unionByName, reports)


def enforce(report: DataFrame) -> list:
    """Raise on a failed critical rule, log a failed soft one; returns the report's rows."""
    rows = report.collect()
    for row in rows:
        if not row["passed"] and row["severity"] != CRITICAL:
            logger.warning("%s: %s failed (%s of %s)", row["layer"], row["rule"], row["failed_rows"], row["total_rows"])
    broken = [row for row in rows if not row["passed"] and row["severity"] == CRITICAL]
    if broken:
        parts = [f"{row['rule']} ({row['failed_rows']} of {row['total_rows']})" for row in broken]
        raise QualityError(f"{broken[0]['layer']}: {'; '.join(parts)}", rows)
    return rows


def conform_columns(df: DataFrame, schema: T.StructType, layer: str) -> DataFrame:
    """Exactly the columns of the schema, in its order and types; a value that does not cast becomes null.

    A missing or surplus column raises at once: it is visible in the plan without reading data.
    """
    missing = [name for name in schema.names if name not in df.columns]
    surplus = [name for name in df.columns if name not in schema.names]
    if missing or surplus:
        raise QualityError(f"{layer}: missing columns {missing}, surplus columns {surplus}")
    return df.select(*[F.col(field.name).try_cast(field.dataType).alias(field.name) for field in schema])


def conform(df: DataFrame, schema: T.StructType, layer: str) -> tuple[DataFrame, DataFrame]:
    """The conformed rows and a report on the values that do not cast."""
    cast = conform_columns(df, schema, layer)
    rules = [
        every_row(
            f"castable({field.name},{field.dataType.simpleString()})",
            F.col(field.name).isNull() | F.col(field.name).try_cast(field.dataType).isNotNull(),
        )
        for field in schema
    ]
    return cast, check(df, rules, layer)


def orphans(child: DataFrame, parent: DataFrame, on: Sequence[str]) -> DataFrame:
    """Child rows whose key the parent lacks."""
    return child.join(parent.select(*on), list(on), "left_anti")


def check_reference(child: DataFrame, parent: DataFrame, on: Sequence[str], layer: str) -> DataFrame:
    """Referential integrity as a report row."""
    marked = child.select(*on).join(
        parent.select(*on).distinct().withColumn("_known", F.lit(True)), list(on), "left"
    )
    return check(marked, [every_row(f"references({','.join(on)})", F.col("_known"))], layer)
