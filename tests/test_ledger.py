from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from demandloom.operators import ledger as L

NOW = dt.datetime(2024, 5, 1, 12)
SCHEMA = "k int, status string, started string, error string, rows long"


def by_key(df, key="k"):
    return {row[key]: tuple(row)[1:] for row in df.collect()}


@pytest.fixture
def target(spark):
    return spark.createDataFrame([(1, "failed", "mon", "boom", 5), (2, "success", "tue", None, 7)], SCHEMA)


def test_upsert_updates_resets_preserves_and_inserts(spark, target):
    source = spark.createDataFrame([(1, "running", "fri", "new", 0), (3, "running", "sat", None, 0)], SCHEMA)
    got = L.upsert(target, source, ["k"], ["status"], {"error": F.lit(None).cast("string")})
    assert got.columns == target.columns
    assert by_key(got) == {
        1: ("running", "mon", None, 5), 2: ("success", "tue", None, 7), 3: ("running", "sat", None, 0),
    }
    again = L.upsert(got, source, ["k"], ["status"], {"error": F.lit(None).cast("string")})
    assert by_key(again) == by_key(got)


def test_insert_ignore(spark, target):
    source = spark.createDataFrame([(2, "running", "x", "x", 1), (4, "running", "y", "y", 1)], SCHEMA)
    got = by_key(L.insert_ignore(target, source, ["k"]))
    assert got[2] == ("success", "tue", None, 7) and got[4] == ("running", "y", "y", 1) and len(got) == 3


def test_keyed_update_touches_only_given_columns(spark, target):
    changes = spark.createDataFrame([(1, "success", None), (8, "failed", "lost")], "k int, status string, error string")
    assert by_key(L.update_by_key(target, changes, ["k"])) == {
        1: ("success", "mon", None, 5), 2: ("success", "tue", None, 7),
    }
    with pytest.raises(KeyError):
        L.update_by_key(target, changes, ["k"], must_match=True)


def test_terminal_stamp(spark):
    df = spark.createDataFrame([("running",), ("success",), ("failed",)], "status string")
    got = dict(map(tuple, df.withColumn("at", L.terminal_stamp("status", NOW)).collect()))
    assert got == {"running": None, "success": NOW, "failed": NOW}


def test_latest_by_breaks_ties(spark):
    df = spark.createDataFrame([("a", 1, 10), ("a", 2, 10), ("b", 3, 9)], "d string, run_id int, created int")
    assert by_key(L.latest_by(df, ["d"], ["created", "run_id"]), "d") == {"a": (2, 10), "b": (3, 9)}


def test_require_status(spark):
    runs = spark.createDataFrame([(1, "success"), (2, "failed")], "run_id int, status string")
    assert L.require_status(runs, 1)["status"] == "success"
    for run_id in (2, 3):
        with pytest.raises(ValueError):
            L.require_status(runs, run_id)


def test_run_outcome_and_metrics(spark):
    steps = spark.createDataFrame(
        [(1, "bronze", "success", 5), (1, "silver", "success", 4), (2, "bronze", "success", 9), (2, "silver", "failed", 0),
         (3, "bronze", "success", 1)],
        "run_id int, step_name string, status string, output_rows long",
    )
    got = by_key(L.run_outcome(steps, ["bronze", "silver"]), "run_id")
    assert got[1] == ("success", None) and got[2][0] == "failed" and "silver=failed" in got[2][1]
    assert got[3] == ("failed", "steps not all successful: bronze=success, silver=none")
    assert by_key(L.step_metrics(steps, ["bronze", "silver"]), "run_id") == {1: (5, 4), 2: (9, 0), 3: (1, 0)}


def test_cascade_and_lineage(spark):
    steps = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "run_id int, step string")
    removed = spark.createDataFrame([(2,)], "run_id int")
    assert [r["step"] for r in L.cascade_delete(steps, removed, ["run_id"]).collect()] == ["a"]
    runs = spark.createDataFrame([("r", "p", dt.date(2020, 1, 1), "success")], "run_id string, pipeline_name string, run_date date, status string")
    sets = spark.createDataFrame([("r", "d", 3, "f", "s")], "run_id string, dataset_id string, total_row_count long, feature_hash string, schema_hash string")
    stages = spark.createDataFrame([("r", "d", "train", "success")], "run_id string, dataset_id string, stage string, status string")
    metrics = spark.createDataFrame([("r", "d", "train", 0.5)], "run_id string, dataset_id string, stage string, wmape double")
    row = L.lineage(runs, sets, stages, metrics).first()
    assert (row["run_status"], row["stage"], row["stage_status"], row["wmape"]) == ("success", "train", "success", 0.5)


def test_a_failed_row_fails_a_step_that_also_has_good_rows(spark):
    rows = [(1, "bronze", "failed"), (1, "bronze", "success"), (2, "bronze", "success"), (2, "bronze", "success"), (3, "bronze", "running"), (3, "bronze", "success")]
    got = L.run_outcome(spark.createDataFrame(rows, "run_id long, step_name string, status string"), ["bronze"]).collect()
    assert {r["run_id"]: r["status"] for r in got} == {1: "failed", 2: "success", 3: "failed"}
