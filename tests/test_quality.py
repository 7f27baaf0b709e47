from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from demandloom.operators import quality as Q
from demandloom.operators import rules as R
from demandloom.schemas import GOLD_SCHEMA, SILVER_SCHEMA, schema_of
from tests.test_features import random_rows, silver_frame
from demandloom.operators.features import gold


def outcome(report):
    return {r["rule"]: (r["failed_rows"], r["passed"]) for r in report.collect()}


def test_row_rules_count_failures(spark):
    df = spark.createDataFrame([(1, "CA"), (-1, None), (None, "NY"), (9, "TX")], "x int, state string")
    got = outcome(Q.check(df, [
        Q.not_null("x"), Q.at_least("x", 0), Q.in_range("x", 0, 5), Q.one_of("state", ["CA", "TX"]),
        Q.one_of("state", ["CA", "TX"], nullable=True), Q.single_value("x"), Q.UniqueKey(("state",)),
    ], "t"))
    assert got == {
        "not_null(x)": (1, False), "at_least(x,0)": (1, False), "in_range(x,0,5)": (2, False),
        "one_of(state)": (2, False), "one_of_or_null(state)": (1, False), "single_value(x)": (1, False),
        "unique(state)": (0, True),
    }


def test_unique_key_counts_keys_not_rows(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 1), (2, 1), (2, 1), (3, 1)], "a int, b int")
    row = Q.check(df, [Q.UniqueKey(("a", "b"))], "t").first()
    assert (row["failed_rows"], row["total_rows"], row["passed"]) == (2, 6, False)
    assert {(r["a"], r["rows"]) for r in Q.duplicate_keys(df, ["a", "b"]).collect()} == {(1, 3), (2, 2)}


def test_rules_on_an_empty_batch(spark):
    df = spark.createDataFrame([], "a int")
    got = outcome(Q.check(df, [Q.not_null("a"), Q.single_value("a"), Q.UniqueKey(("a",))], "t"))
    assert got == {"not_null(a)": (0, True), "single_value(a)": (1, False), "unique(a)": (0, True)}


def test_layers_pass_their_own_rules(spark):
    rows = silver_frame(spark, random_rows(days=30)).fillna(0, subset=["snap_tx"])
    Q.enforce(Q.check(rows, R.silver_rules(single_date=False), "silver"))
    Q.enforce(Q.check(gold(rows), R.gold_rules(["CA"], ["National"], single_date=False), "gold"))
    with pytest.raises(Q.QualityError, match="single_value"):
        Q.enforce(Q.check(rows, R.silver_rules(), "silver"))
    with pytest.raises(Q.QualityError, match="one_of.state_id"):
        Q.enforce(Q.check(gold(rows), R.gold_rules(["TX"], ["National"], single_date=False), "gold"))


def test_time_order_needs_a_time(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2020, 1, 2), dt.date(2020, 1, 1)), (None, dt.date(2020, 1, 1)), (dt.datetime(2019, 1, 1), dt.date(2020, 1, 1))],
        "t timestamp, d date",
    )
    assert outcome(Q.check(df, [Q.not_before("t", "d")], "t"))["not_before(t,d)"] == (2, False)


def test_soft_rules_warn_and_critical_rules_raise(spark, caplog):
    df = spark.createDataFrame([(0,), (0,)], "x int")
    soft, hard = (Q.batch("moves", F.stddev_samp("x") > 0, kind) for kind in (Q.SOFT, Q.CRITICAL))
    with caplog.at_level("WARNING"):
        assert len(Q.enforce(Q.check(df, [soft], "ml"))) == 1
    assert "moves" in caplog.text
    with pytest.raises(Q.QualityError, match="moves"):
        Q.enforce(Q.check(df, [hard], "ml"))


def test_learner_rules(spark):
    rows = gold(silver_frame(spark, random_rows(days=60)))
    assert all(ok for _, ok in outcome(Q.check(rows, R.ml_critical_rules(), "ml")).values())
    soft = outcome(Q.check(rows, R.ml_soft_rules(), "ml"))
    assert not soft["cold_start_missing(sales_lag_1)"][1] and soft["p99(sales)"][1] and soft["priced(sell_price)"][1]
    flat = outcome(Q.check(rows.withColumn("sales", F.lit(0)), R.ml_critical_rules(), "ml"))
    assert not flat["mean_positive(sales)"][1] and not flat["std_positive(sales)"][1]


def test_contract(spark):
    schema = schema_of(["d", "sales", "run_date"])
    raw = spark.createDataFrame([("d_1", "3", "2020-01-01"), ("d_2", "x", "never")], "d string, sales string, run_date string")
    cast, report = Q.conform(raw.select("run_date", "sales", "d"), schema, "t")
    assert cast.schema.simpleString() == schema.simpleString()
    assert [tuple(r) for r in cast.orderBy("d").collect()] == [("d_1", 3, dt.date(2020, 1, 1)), ("d_2", None, None)]
    assert outcome(report)["castable(sales,int)"] == (1, False) and outcome(report)["castable(d,string)"] == (0, True)
    with pytest.raises(Q.QualityError, match="missing"):
        Q.conform_columns(raw.drop("d"), schema, "t")
    with pytest.raises(Q.QualityError, match="surplus"):
        Q.conform_columns(raw.withColumn("more", F.lit(1)), schema, "t")


def test_layer_schemas_match_what_the_layers_build(spark):
    rows = silver_frame(spark, random_rows(days=10))
    assert rows.schema.simpleString() == SILVER_SCHEMA.simpleString()
    assert gold(rows).schema.simpleString() == GOLD_SCHEMA.simpleString()


def test_references(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (9,)], "run_id int")
    parent = spark.createDataFrame([(1,), (1,), (2,)], "run_id int")
    assert outcome(Q.check_reference(child, parent, ["run_id"], "t")) == {"references(run_id)": (1, False)}
    assert [r["run_id"] for r in Q.orphans(child, parent, ["run_id"]).collect()] == [9]
