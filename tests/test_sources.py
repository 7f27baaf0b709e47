from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from demandloom.operators.dedup import keep_first
from demandloom.sources import csv, libsvm, tables
from demandloom.schemas import BRONZE_COLUMNS, CALENDAR_COLUMNS

BASE = dt.date(2011, 1, 29)
HEADER = "item_id,dept_id,cat_id,store_id,state_id,d_1,d_2,d_3"


@pytest.fixture
def wide(tmp_path):
    """Two files: a repeated series in the first one and again in the second."""
    folder = tmp_path / "sales"
    folder.mkdir()
    (folder / "part-0.csv").write_text(
        f"{HEADER}\nA,D,C,S1,CA,1,abc,3.9\nB,D,C,S1,CA,4,,NaN\nA,D,C,S1,CA,70,71,72\n"
    )
    (folder / "part-1.csv").write_text(f"{HEADER}\nB,D,C,S1,CA,80,81,82\nA,D,C,S2,TX,5,6,7\n")
    return str(folder)


def test_all_days_of_a_wide_file(spark, wide):
    rows = csv.read_wide_sales(spark, wide, BASE)
    assert rows.columns == BRONZE_COLUMNS
    found = {(r["item_id"], r["store_id"], r["d"]): (r["sales"], r["run_date"]) for r in rows.collect()}
    assert len(found) == rows.count() == 9
    assert [found["A", "S1", f"d_{n}"][0] for n in (1, 2, 3)] == [1, 0, 3]
    assert [found["B", "S1", f"d_{n}"][0] for n in (1, 2, 3)] == [4, 0, 0]
    assert found["A", "S2", "d_3"] == (7, dt.date(2011, 1, 31))


def test_one_day_equals_its_part_of_all_days(spark, wide):
    day = dt.date(2011, 1, 30)
    one = csv.read_wide_sales(spark, wide, BASE, [day])
    every = csv.read_wide_sales(spark, wide, BASE).where(F.col("run_date") == F.lit(day))
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, every.collect()))


def test_one_day_reads_one_day_column(spark, wide):
    plan = csv.read_wide_sales(spark, wide, BASE, [BASE])._jdf.queryExecution().toString()
    schema = plan[plan.rindex("ReadSchema"):].split(">")[0]
    assert "d_1:" in schema and "d_2" not in schema and "d_3" not in schema


def test_unknown_day_and_early_day_are_refused(spark, wide):
    with pytest.raises(ValueError, match="d_4"):
        csv.read_wide_sales(spark, wide, BASE, [dt.date(2011, 2, 1)])
    with pytest.raises(ValueError, match="before"):
        csv.read_wide_sales(spark, wide, BASE, [dt.date(2011, 1, 1)])


def test_calendar_headers_flags_and_sentinels(spark, tmp_path):
    path = tmp_path / "calendar.csv"
    path.write_text(
        "date,wm_yr_wk,weekday,wday,month,year,d,event_name_1,event_type_1,event_name_2,event_type_2,snap_CA,snap_TX,snap_WI,extra\n"
        "2011-01-29,11101,Saturday,1,1,2011,d_1,NaN,NaN,,,,0,1,x\n"
    )
    rows = csv.read_calendar(spark, str(path))
    assert rows.columns == CALENDAR_COLUMNS
    row = rows.first()
    assert (row["snap_ca"], row["snap_tx"], row["snap_wi"]) == (0, 0, 1)
    assert row["date"] == BASE and row["event_type_1"] == "NaN" and row["event_name_2"] is None


def test_prices(spark, tmp_path):
    path = tmp_path / "prices.csv"
    path.write_text("store_id,item_id,wm_yr_wk,sell_price\nS1,A,11101,9.58\nS1,B,11101,oops\n")
    rows = {r["item_id"]: r["sell_price"] for r in csv.read_prices(spark, str(path)).collect()}
    assert rows == {"A": 9.58, "B": None}
    path.write_text("store_id,item_id,wm_yr_wk\nS1,A,11101\n")
    with pytest.raises(ValueError, match="sell_price"):
        csv.read_prices(spark, str(path))


def test_keep_first_with_a_hot_key(spark):
    """A third of the rows share one key."""
    rows = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), (F.col("id") * 7 % 9001).alias("v")
    )
    kept = {r["k"]: r["v"] for r in keep_first(rows, ["k"], F.col("v")).collect()}
    assert len(kept) == 6001 and kept[-1] == min(i * 7 % 9001 for i in range(0, 9000, 3))


def test_libsvm_keeps_width_and_values(spark, tmp_path):
    from pyspark.ml.functions import array_to_vector, vector_to_array

    df = spark.createDataFrame([(1.0, [0.0, 2.5, 0.0]), (0.0, [1.0, 0.0, 0.0])], "label double, cells array<double>")
    path = str(tmp_path / "svm")
    libsvm.write_libsvm(df.withColumn("features", array_to_vector("cells")), path)
    read = libsvm.read_libsvm(spark, path, 3).select("label", vector_to_array("features").alias("cells"))
    assert sorted(map(tuple, read.collect())) == sorted(map(tuple, df.collect()))


def test_scans_prune_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    days = [dt.date(2020, 1, n) for n in (1, 2, 3, 5)]
    df = spark.createDataFrame([("i", day) for day in days], "item_id string, run_date date")
    df.write.partitionBy("run_date").parquet(path)
    table = spark.read.parquet(path)
    for scan, size in [
        (tables.scan_partition(table, days[1]), 1), (tables.scan_history(table, days[2]), 3),
        (tables.scan_between(table, days[1], days[2]), 2), (tables.scan_partitions(table, [days[0], days[3]]), 2),
    ]:
        assert scan.count() == size
        plan = scan._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(run_date" in plan or "PartitionFilters: [run_date" in plan
    some = tables.read_days(spark, path, df.schema, [days[0], dt.date(2020, 1, 4)])
    assert [r["run_date"] for r in some.collect()] == [days[0]]
    assert len(some.inputFiles()) == 1
    with pytest.raises(ValueError, match="sales"):
        tables.scan_columns(spark, path, ["item_id", "sales"])
