"""How the plans behave when one key holds a third of the rows and nothing is small enough to broadcast."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from demandloom import fixtures as X
from demandloom.operators.rules import percentile_below
from demandloom.operators import encoding, evaluation, joins, quality
from demandloom.operators.storage import scoped_settings
from demandloom.plans.training import load_best

SHUFFLED = {
    "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false", "spark.sql.shuffle.partitions": "16",
}


def hot_rows(spark, n=60000):
    hot = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 5000).cast("string")))
    return spark.range(n).repartition(8).select("id", hot.alias("item_id"), F.sha2(F.col("id").cast("string"), 256).alias("pad"))


def final_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_hot_value_is_split_in_a_shuffled_lookup(spark, tmp_path):
    rows = hot_rows(spark)
    path = str(tmp_path / "vocabulary")
    encoding.fit_vocabulary(rows, ["item_id"]).write.partitionBy("column").parquet(path)
    vocabulary = spark.read.parquet(path)
    codes = {r["value"]: r["code"] for r in vocabulary.collect()}
    small = encoding.encode(rows, vocabulary, ["item_id"])
    with scoped_settings(spark, SHUFFLED):
        large = encoding.encode(rows, vocabulary, ["item_id"])
        found = {r["id"]: r["item_id"] for r in large.collect()}
        assert "skew=true" in final_plan(large)
    assert "BroadcastHashJoin" in final_plan(small)
    assert found == {r["id"]: r["item_id"] for r in small.collect()}
    assert found[0] == codes["hot"] and len(found) == 60000


def test_a_hot_parent_is_split_in_a_reference_check(spark):
    child = hot_rows(spark)
    parent = child.select("item_id").distinct().where("item_id <> 'k1'")
    with scoped_settings(spark, SHUFFLED):
        row = quality.check_reference(child, parent, ["item_id"], "t").first()
    assert row["failed_rows"] == child.where("item_id = 'k1'").count() and row["total_rows"] == 60000


def test_grouped_measures_combine_before_the_shuffle(spark):
    df = hot_rows(spark).select(
        F.col("item_id").alias("store_id"), F.lit("d").alias("dept_id"), (F.col("id") % 7).cast("double").alias("sales"),
        F.lit(3.0).alias("prediction"), F.lit(2.0).alias("baseline_prediction"),
    )
    plan = final_plan(evaluation.slice_metrics(df))
    assert plan.index("partial_") > plan.index("Exchange")
    rows = {(r["slice"], r["value"]): r["rows"] for r in evaluation.slice_metrics(df).collect()}
    assert rows["store_id", "hot"] == 20000 and rows["dept_id", "d"] == 60000


def test_calendar_join_is_left_to_the_planner(spark):
    days = X.calendar(spark, "/root/testdata/sf0.001")
    facts = hot_rows(spark).select(F.concat(F.lit("d_"), (F.col("id") % 50).cast("string")).alias("d"))
    with scoped_settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        assert "BroadcastHashJoin" not in final_plan(joins.join_calendar(facts, days))


def test_percentile_rule_equals_the_exact_percentile_without_a_map_of_values(spark):
    for size, limit in ((1, 0.5), (1, 5.0), (100, 97.0), (100, 98.01), (101, 99.0), (101, 98.9), (3, 2.0), (250, 246.5), (250, 246.4)):
        df = spark.range(size).select(F.col("id").cast("double").alias("sales"))
        both = df.agg(percentile_below("sales", 99, limit).alias("ours"), (F.percentile("sales", 0.99) < limit).alias("exact")).first()
        assert both["ours"] == both["exact"], (size, limit)
    many = spark.range(10_000_000).select(F.col("id").cast("double").alias("sales")).agg(percentile_below("sales", 99, 9_900_000.0).alias("ok"))
    assert many.first()["ok"] and "percentile" not in final_plan(many)


def test_raw_scans_read_only_what_they_need(spark):
    plan = final_plan(X.sales_daily(spark, "/root/testdata/sf0.001"))
    line = next(part for part in plan.split("\n") if "l_quantity" in part and "ReadSchema" in part)
    read = line[line.index("ReadSchema"):]
    assert all(name in read for name in ("l_partkey", "l_suppkey", "l_shipdate", "l_quantity"))
    assert "l_extendedprice" not in read and "l_tax" not in read


def test_no_recorded_model(spark, tmp_path):
    with pytest.raises(ValueError, match="no best_model"):
        load_best(spark, str(tmp_path))
    spark.createDataFrame([("other",)], "best_model string").write.json(str(tmp_path / "selection"))
    with pytest.raises(ValueError, match="unknown best_model"):
        load_best(spark, str(tmp_path))
