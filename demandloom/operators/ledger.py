"""Keyed state in tables without in-place updates: each operator returns the next snapshot."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update: Sequence[str] = (),
    reset: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Insert new keys; on a known key take ``update`` columns from the source and set ``reset`` columns.

    All other columns of a known key are preserved. The source holds at most one row per key.
    """
    reset = reset or {}
    old, new = target.alias("old"), source.withColumn("_new", F.lit(True)).alias("new")
    joined = old.withColumn("_old", F.lit(True)).alias("old").join(new, list(keys), "full_outer")
    both = F.col("_old").isNotNull() & F.col("_new").isNotNull()
    columns = []
    for name in target.columns:
        if name in keys:
            columns.append(F.col(name))
            continue
        before, after = F.col(f"old.{name}"), F.col(f"new.{name}")
        inserted = F.when(F.col("_old").isNull(), after).otherwise(before)
        if name in reset:
            columns.append(F.when(both, reset[name]).otherwise(inserted).alias(name))
        elif name in update:
            columns.append(F.when(F.col("_new").isNotNull(), after).otherwise(before).alias(name))
        else:
            columns.append(inserted.alias(name))
    return joined.select(*columns)


def insert_ignore(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add the source rows whose key is new; known keys keep their row."""
    return target.unionByName(source.join(target.select(*keys), list(keys), "left_anti"))


def update_by_key(
    target: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    must_match: bool = False,
) -> DataFrame:
    """Overwrite the supplied columns of known keys; keys the target lacks are ignored.

    With ``must_match`` a change without a target row raises (ledger tables are small: this is one count).
    """
    if must_match and not changes.join(target.select(*keys), list(keys), "left_anti").isEmpty():
        raise KeyError(f"no row for some of the given keys ({', '.join(keys)})")
    changed = [name for name in changes.columns if name not in keys]
    marked = changes.withColumn("_hit", F.lit(True)).alias("new")
    joined = target.alias("old").join(marked, list(keys), "left")
    columns = [
        F.when(F.col("_hit"), F.col(f"new.{name}")).otherwise(F.col(f"old.{name}")).alias(name)
        if name in changed
        else (F.col(name) if name in keys else F.col(f"old.{name}"))
        for name in target.columns
    ]
    return joined.select(*columns)


def terminal_stamp(status: str | Column, clock: dt.datetime | Column) -> Column:
    """The end time of a finished state; null while running."""
    state = F.col(status) if isinstance(status, str) else status
    when = clock if isinstance(clock, Column) else F.lit(clock).cast("timestamp")
    return F.when(state.isin("success", "failed"), when)


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row per key in the given order; combined before the shuffle."""
    rest = [name for name in df.columns if name not in keys]
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_last"))
    return picked.select(*[F.col(name) if name in keys else F.col("_last")[name].alias(name) for name in df.columns])


def require_status(runs: DataFrame, run_id, status: str = "success") -> dict:
    """The run's row as a dict; raises when it is missing or in another state."""
    rows = runs.where(F.col("run_id") == F.lit(run_id)).limit(1).collect()
    if not rows:
        raise ValueError(f"no run with run_id={run_id}")
    if rows[0]["status"] != status:
        raise ValueError(f"run {run_id} is {rows[0]['status']}, not {status}")
    return rows[0].asDict()


def run_outcome(steps: DataFrame, names: Sequence[str]) -> DataFrame:
    """Step states folded into the state of their run: success only if every named step succeeded.

    One pivoted value per named step, so a run with any number of rows stays one bounded group.
    """
    def state(name: str) -> Column:
        """One failed row fails a step that also has good rows."""
        mine = F.when(F.col("step_name") == name, F.col("status"))
        return (
            F.when(F.bool_or(mine == "failed"), "failed").when(F.bool_and(mine == "success"), "success")
            .otherwise(F.min(mine)).alias(name)
        )

    states = [state(name) for name in names]
    wide = steps.groupBy("run_id").agg(*states)
    succeeded = F.lit(True)
    for name in names:
        succeeded = succeeded & F.coalesce(F.col(name) == "success", F.lit(False))
    listing = F.concat_ws(
        ", ", *[F.concat(F.lit(f"{name}="), F.coalesce(F.col(name), F.lit("none"))) for name in names]
    )
    message = F.concat(F.lit("steps not all successful: "), listing)
    return wide.select(
        "run_id", F.when(succeeded, "success").otherwise("failed").alias("status"),
        F.when(~succeeded, message).alias("error_message"),
    )


def step_metrics(steps: DataFrame, names: Sequence[str]) -> DataFrame:
    """Output rows of each step as columns of its run."""
    return steps.groupBy("run_id").agg(
        *[
            F.coalesce(F.sum(F.when(F.col("step_name") == name, F.col("output_rows"))), F.lit(0))
            .cast("long").alias(f"rows_{name}")
            for name in names
        ]
    )


def cascade_delete(child: DataFrame, removed: DataFrame, on: Sequence[str]) -> DataFrame:
    """The child rows that stay when the parents in ``removed`` go."""
    return child.join(removed.select(*on), list(on), "left_anti")


def lineage(runs: DataFrame, datasets: DataFrame, stages: DataFrame, metrics: DataFrame | None = None) -> DataFrame:
    """Run, dataset, stage and the stage's metrics side by side; a stage without metrics keeps its row."""
    view = (
        runs.select("run_id", "pipeline_name", "run_date", F.col("status").alias("run_status"))
        .join(datasets.select("run_id", "dataset_id", "total_row_count", "feature_hash", "schema_hash"), "run_id")
        .join(
            stages.select("run_id", "dataset_id", "stage", F.col("status").alias("stage_status")),
            ["run_id", "dataset_id"], "left",
        )
    )
    if metrics is None:
        return view
    return view.join(metrics, ["run_id", "dataset_id", "stage"], "left")
