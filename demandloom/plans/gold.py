"""Gold: features of some days from the silver history.

A day's features need the last 28 rows of each series, however far back they lie. Reading the whole history for
every new day costs more with each day, so each run leaves a tail: the last 28 rows per series as of its newest
day. The next run reads that tail and the silver days after it. A silver run drops every tail that covers one of
its days, so a tail that exists always agrees with the silver table; without one the history is read in full.
"""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from demandloom.config import PipelineConfig
from demandloom.operators.features import gold
from demandloom.operators.quality import EmptyBatch, conform_columns
from demandloom.operators.rules import gold_rules
from demandloom.operators.storage import Batch, Snapshot, partition_days, publish, snapshot_of
from demandloom.schemas import GOLD_SCHEMA, LAGS, SERIES_KEY, SILVER_SCHEMA, TARGET, WINDOWS, schema_of
from demandloom.sources.tables import read_days, scan_partitions

SILVER, GOLD, TAIL = "silver_table", "gold_table", "series_tail"
HISTORY_COLUMNS = [*SERIES_KEY, "run_date", TARGET]
TAIL_SCHEMA = schema_of(HISTORY_COLUMNS).add("as_of", "date")
DEPTH = max(*LAGS, *WINDOWS)
logger = logging.getLogger(__name__)


def narrow_history(
    spark: SparkSession, cfg: PipelineConfig, run_dates: Sequence[dt.date], days: Sequence[dt.date], at: Snapshot | None = None
) -> DataFrame:
    """Key, date and sales of the rows the windows look back on; no other column of old rows is read.

    ``days`` are the silver days. Only the days after the newest usable tail are opened.
    """
    at = at or snapshot_of(spark, cfg.table(SILVER))
    first, last = min(run_dates), max(run_dates)
    older = [day for day in days if day < last and day not in set(run_dates)]
    tails = partition_days(spark, cfg.table(TAIL), at)
    usable = [day for day in tails if day < first]
    if not usable:
        if tails:
            logger.warning("no tail before %s (oldest %s): reading all %s silver days before it", first, tails[0], len(older))
        return read_days(spark, cfg.table(SILVER), SILVER_SCHEMA, older, at).select(*HISTORY_COLUMNS)
    tail = read_days(spark, cfg.table(TAIL), TAIL_SCHEMA, usable[-1:], at).select(*HISTORY_COLUMNS)
    since = [day for day in older if day > usable[-1]]
    return tail.unionByName(read_days(spark, cfg.table(SILVER), SILVER_SCHEMA, since, at).select(*HISTORY_COLUMNS))


def gold_for(history: DataFrame, targets: DataFrame, run_dates: Sequence[dt.date], first_day: dt.date | DataFrame) -> DataFrame:
    """Gold rows of the target days. History rows carry only what the windows read; the rest is null there."""
    rows = targets.unionByName(history, allowMissingColumns=True)
    return scan_partitions(gold(rows, first_day), run_dates)


def series_tail(rows: DataFrame, depth: int = DEPTH) -> DataFrame:
    """The last rows of each series; Spark cuts to ``depth`` per series before the shuffle as well."""
    newest = Window.partitionBy(*SERIES_KEY).orderBy(F.col("run_date").desc())
    return rows.withColumn("_age", F.row_number().over(newest)).where(F.col("_age") <= depth).drop("_age")


def run_gold(
    spark: SparkSession, cfg: PipelineConfig, run_dates: Sequence[dt.date], keep_tail: bool = True
) -> list[str]:
    """Build the gold partitions of some days and the tail after them from one snapshot, and publish both at once.

    Refused if a silver day they look back on was published meanwhile.
    """
    root = cfg.table(SILVER)
    at = snapshot_of(spark, root)
    days = partition_days(spark, root, at)
    missing = sorted(set(run_dates) - set(days))
    if missing:
        raise EmptyBatch(f"no silver rows for {', '.join(day.isoformat() for day in missing)}")
    targets = read_days(spark, root, SILVER_SCHEMA, run_dates, at)
    history = narrow_history(spark, cfg, run_dates, days, at)
    rules = gold_rules(cfg.states, cfg.event_types, single_date=len(set(run_dates)) == 1)
    rows = conform_columns(gold_for(history, targets, run_dates, days[0]), GOLD_SCHEMA, "gold")
    batches = [Batch(
        rows, cfg.table(GOLD), "run_date", None, ("item_id", "store_id"), tuple(day.isoformat() for day in run_dates),
        rules=tuple(rules), layer="gold",
    )]
    if keep_tail:
        batches.append(tail_batch(history.unionByName(targets.select(*HISTORY_COLUMNS)), spark, cfg, max(run_dates), at))
    return publish(batches, at, relied={root: lambda value: value <= max(run_dates).isoformat()})[0]


def tail_batch(rows: DataFrame, spark: SparkSession, cfg: PipelineConfig, day: dt.date, at: Snapshot) -> Batch:
    """The tail as of a day; it takes the place of the oldest ones when it is published."""
    tail = series_tail(rows).withColumn("as_of", F.lit(day))
    kept = sorted({*partition_days(spark, cfg.table(TAIL), at), day})[-cfg.tails_kept :]
    old = [d.isoformat() for d in partition_days(spark, cfg.table(TAIL), at) if d not in kept]
    return Batch(tail, cfg.table(TAIL), "as_of", None, (*SERIES_KEY, "run_date"), dropped=tuple(old))


def write_tail(rows: DataFrame, spark: SparkSession, cfg: PipelineConfig, day: dt.date) -> None:
    at = snapshot_of(spark, cfg.table(TAIL))
    publish([tail_batch(rows, spark, cfg, day, at)], at)
