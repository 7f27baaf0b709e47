from __future__ import annotations

import datetime as dt
import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from demandloom.operators import features
from demandloom.operators.joins import silver
from demandloom.plans.gold import HISTORY_COLUMNS, gold_for, series_tail
from demandloom.schemas import GOLD_COLUMNS, LAGS, SILVER_COLUMNS, SILVER_SCHEMA, WINDOWS

START = dt.date(2020, 1, 1)


def silver_frame(spark, rows):
    """Silver rows from ``(item, store, day offset, sales)``."""
    filled = []
    for item, store, offset, sales in rows:
        day = START + dt.timedelta(days=offset)
        values = {
            "run_date": day, "_processed_time": dt.datetime(2030, 1, 1), "_pipeline_version": "v1", "store_id": store,
            "item_id": item, "d": f"d_{offset + 1}", "date": day, "dept_id": "D", "cat_id": "C", "state_id": "CA",
            "sales": sales, "sell_price": 1.5, "wm_yr_wk": 1, "weekday": "x", "wday": 1, "month": day.month,
            "year": day.year, "snap_ca": 0, "snap_tx": None, "snap_wi": 1,
        }
        filled.append(tuple(values.get(name) for name in SILVER_COLUMNS))
    return spark.createDataFrame(filled, SILVER_SCHEMA)


def random_rows(seed=3, series=6, days=90):
    rng = random.Random(seed)
    return [
        (f"i{s % 3}", f"s{s // 3}", day, rng.randint(0, 40))
        for s in range(series) for day in range(days) if rng.random() < (0.9 if s else 0.1)
    ]


def expected_features(rows):
    """The same features by plain loops."""
    first = min(row[2] for row in rows)
    history, out = {}, {}
    for item, store, day, sales in sorted(rows, key=lambda row: row[2]):
        past = history.setdefault((item, store), [])
        mean = {n: statistics.fmean(past[-n:]) if past else None for n in WINDOWS}
        std = {n: statistics.stdev(past[-n:]) if len(past[-n:]) > 1 else 0.0 for n in WINDOWS}
        stand_in = {1: 7, 3: 7, 7: 7, 14: 14, 28: 28}
        lags = [
            past[-k] if len(past) >= k else math.floor((mean[stand_in[k]] or 0.0) + 0.5) for k in LAGS
        ]
        out[item, store, day] = (
            lags, [round(mean[n] or 0.0, 4) for n in WINDOWS], [round(std[n], 4) for n in WINDOWS],
            day < first + 28,
        )
        past.append(sales)
    return out


def as_features(df):
    return {
        (r["item_id"], r["store_id"], (r["run_date"] - START).days): (
            [r[f"sales_lag_{k}"] for k in LAGS], [r[f"sales_roll_mean_{n}"] for n in WINDOWS],
            [r[f"sales_roll_std_{n}"] for n in WINDOWS], r["is_cold_start"],
        )
        for r in df.collect()
    }


@pytest.mark.parametrize("seed", [1, 2])
def test_features_equal_plain_loops(spark, seed):
    rows = random_rows(seed)
    got, want = as_features(features.gold(silver_frame(spark, rows))), expected_features(rows)
    assert got.keys() == want.keys()
    for key, (lags, means, stds, cold) in want.items():
        assert got[key][0] == lags and got[key][3] == cold, key
        assert got[key][1] == pytest.approx(means, abs=1.1e-4) and got[key][2] == pytest.approx(stds, abs=1.1e-4), key


def test_gold_columns_and_defaults(spark):
    row = features.gold(silver_frame(spark, [("i", "s", 0, 5)])).first()
    assert list(row.asDict()) == GOLD_COLUMNS
    assert [row[f"sales_lag_{k}"] for k in LAGS] == [0] * 5 and row["sales_roll_std_28"] == 0.0
    assert row["snap_tx"] == 0 and row["is_cold_start"] is True


def test_one_pass_equals_a_run_per_date(spark):
    rows = random_rows(5, days=50)
    frame = silver_frame(spark, rows)
    once = as_features(features.gold(frame, START))
    for offset in (0, 17, 49):
        day = START + dt.timedelta(days=offset)
        targets = frame.where(F.col("run_date") == F.lit(day))
        history = frame.where(F.col("run_date") < F.lit(day)).select(*HISTORY_COLUMNS)
        alone = as_features(gold_for(history, targets, [day], START))
        assert alone == {key: value for key, value in once.items() if key[2] == offset}


def test_tail_stands_in_for_the_history(spark):
    rows = random_rows(8)
    frame = silver_frame(spark, rows)
    day = START + dt.timedelta(days=89)
    targets = frame.where(F.col("run_date") == F.lit(day))
    history = frame.where(F.col("run_date") < F.lit(day)).select(*HISTORY_COLUMNS)
    tail = series_tail(history)
    assert tail.groupBy("item_id", "store_id").count().agg(F.max("count")).first()[0] == 28
    assert as_features(gold_for(tail, targets, [day], START)) == as_features(gold_for(history, targets, [day], START))


def test_later_sales_change_no_earlier_feature(spark):
    rows = random_rows(9, days=40)
    changed = [(i, s, day, sales + 100 if day >= 20 else sales) for i, s, day, sales in rows]
    before, after = (as_features(features.gold(silver_frame(spark, r), START)) for r in (rows, changed))
    assert all(before[key] == after[key] for key in before if key[2] <= 20)


def test_one_shuffle_one_sort_one_window(spark):
    plan = features.gold(silver_frame(spark, random_rows()), START)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(item_id") == 1 and plan.count("Exchange") == 1
    assert plan.count("Window [") == 1 and plan.count("Sort [") == 1


def test_tail_is_cut_before_its_shuffle(spark):
    history = silver_frame(spark, random_rows()).select(*HISTORY_COLUMNS)
    plan = series_tail(history)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit")


def test_silver_join_semantics(spark):
    bronze = spark.createDataFrame(
        [("A", "S", "D", "C", "CA", "d_1", 3, START, "v0"), ("A", "S", "D", "C", "CA", "d_9", 3, START, "v0"),
         ("B", "S", "D", "C", "CA", "d_1", 4, START, "v0")],
        "item_id string, store_id string, dept_id string, cat_id string, state_id string, d string, sales int, "
        "run_date date, _pipeline_version string",
    )
    calendar = spark.createDataFrame(
        [("d_1", START, 7, "Wed", 5, 1, 2020, "NaN", "NaN", "Eid", "Religious", None, 1, 0)],
        "d string, date date, wm_yr_wk int, weekday string, wday int, month int, year int, event_name_1 string, "
        "event_type_1 string, event_name_2 string, event_type_2 string, snap_ca int, snap_tx int, snap_wi int",
    )
    prices = spark.createDataFrame([("S", "A", 7, 2.5)], "store_id string, item_id string, wm_yr_wk int, sell_price double")
    rows = {r["item_id"]: r for r in silver(bronze, calendar, prices, dt.datetime(2030, 1, 1), "v2").collect()}
    assert set(rows) == {"A", "B"}
    assert rows["A"]["sell_price"] == 2.5 and rows["B"]["sell_price"] is None
    assert rows["A"]["event_type_1"] is None and rows["A"]["event_name_1"] is None and rows["A"]["event_type_2"] == "Religious"
    assert rows["A"]["snap_ca"] == 0 and rows["A"]["_pipeline_version"] == "v2"
    kept = silver(bronze, calendar, prices, dt.datetime(2030, 1, 1), names_too=False).first()
    assert kept["event_name_1"] == "NaN" and kept["event_type_1"] is None
