from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from demandloom.functions import metrics as M
from demandloom.functions import scalars as C

BASE = dt.date(2011, 1, 29)


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_day_labels_agree_on_driver_and_executors(spark):
    day = dt.date(2013, 10, 24)
    assert C.day_label(day, BASE) == "d_1000" == one(spark, C.day_id(F.lit(day), BASE))
    assert one(spark, C.day_date(F.lit("d_1000"), BASE)) == day
    assert C.day_label(BASE, BASE) == "d_1"


def test_day_before_base_raises(spark):
    early = BASE - dt.timedelta(days=1)
    with pytest.raises(ValueError):
        C.day_label(early, BASE)
    with pytest.raises(Exception, match="before the first day"):
        one(spark, C.day_id(F.lit(early), BASE))


@pytest.mark.parametrize(
    ("text", "expected"),
    [("7", 7), ("3.9", 3), ("-2.7", -2), ("abc", 0), ("", 0), (None, 0), ("NaN", 0), (" 5 ", 5), ("1e2", 100), ("1d", 0)],
)
def test_safe_int(spark, text, expected):
    assert one(spark, C.safe_int(F.lit(text).cast("string"))) == expected


def test_safe_date_and_sentinel(spark):
    assert one(spark, C.safe_date(F.lit("2020-02-30"))) is None
    assert one(spark, C.safe_date(F.lit("2020-02-29"))) == dt.date(2020, 2, 29)
    assert one(spark, C.sentinel_null(F.lit("NaN"))) is None
    assert one(spark, C.sentinel_null(F.lit("Sporting"))) == "Sporting"


def test_weekend_and_quarter(spark):
    flags = [one(spark, C.is_weekend(F.lit(dt.date(2024, 1, day)))) for day in range(1, 8)]
    assert flags == [0, 0, 0, 0, 0, 1, 1]
    assert one(spark, C.quarter(F.lit(dt.date(2024, 10, 1)))) == 4


def test_cold_start_ends_after_28_days(spark):
    first = F.lit(BASE)
    assert one(spark, C.is_cold_start(F.lit(BASE + dt.timedelta(days=27)), first)) is True
    assert one(spark, C.is_cold_start(F.lit(BASE + dt.timedelta(days=28)), first)) is False


def test_missing_lag_rounds_half_away_from_zero(spark):
    null = F.lit(None).cast("int")
    assert one(spark, C.lag_or_mean(null, F.lit(2.5))) == 3
    assert one(spark, C.lag_or_mean(null, F.lit(None).cast("double"))) == 0
    assert one(spark, C.lag_or_mean(F.lit(4), F.lit(9.0))) == 4


def test_fingerprint_ignores_order_and_tells_parts_apart(spark):
    a, b = F.lit("a=1"), F.lit("b=2")
    assert one(spark, C.fingerprint([a, b])) == one(spark, C.fingerprint([b, a]))
    assert one(spark, C.fingerprint([a, b])) != one(spark, C.fingerprint([a, F.lit("b=3")]))


def test_metrics_by_hand(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (5.0, 2.0)], "y double, p double")
    row = df.agg(
        M.rmse("y", "p").alias("rmse"), M.mae("y", "p").alias("mae"), M.wmape("y", "p").alias("wmape"),
        M.bias("y", "p").alias("bias"), M.r2("y", "p").alias("r2"), M.error_std("y", "p").alias("std"),
    ).first()
    assert row["rmse"] == pytest.approx((10 / 3) ** 0.5)
    assert row["mae"] == pytest.approx(4 / 3)
    assert row["wmape"] == pytest.approx(4 / 9)
    assert row["bias"] == pytest.approx(2 / 3)
    assert row["r2"] == pytest.approx(1 - 10 / 8)
    assert row["std"] == pytest.approx((((-1 - 2 / 3) ** 2 + (2 / 3) ** 2 + (3 - 2 / 3) ** 2) / 2) ** 0.5)


def test_improvement_is_null_on_a_perfect_baseline(spark):
    assert one(spark, M.improvement_pct(F.lit(0.0), F.lit(1.0))) is None
    assert one(spark, M.improvement_pct(F.lit(4.0), F.lit(3.0))) == 25.0


def test_numbers_no_int_holds_become_zero(spark):
    texts = ["1e20", "3000000000", "Infinity", "-Infinity", "NaN", "x", None, "7.9"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(C.safe_int("t").alias("n"))
    assert [r["n"] for r in df.collect()] == [0, 0, 0, 0, 0, 0, 0, 7]
