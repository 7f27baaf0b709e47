"""Silver: sales with calendar and price, checked before they are published."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandloom.config import PipelineConfig
from demandloom.functions.scalars import day_label
from demandloom.operators.joins import silver
from demandloom.operators.quality import conform_columns
from demandloom.operators.rules import silver_rules
from demandloom.operators.storage import Batch, days_from, publish, snapshot_of
from demandloom.plans.bronze import BRONZE, CALENDAR, PRICES
from demandloom.plans.gold import SILVER, TAIL
from demandloom.schemas import BRONZE_SCHEMA, CALENDAR_SCHEMA, PRICE_SCHEMA, SILVER_SCHEMA
from demandloom.sources.tables import read_days, read_table


def prices_for(prices: DataFrame, calendar: DataFrame, labels: Sequence[str]) -> DataFrame:
    """The prices of the weeks the given days lie in; the bounds are one row from the calendar."""
    weeks = calendar.where(F.col("d").isin(list(labels))).agg(F.min("wm_yr_wk"), F.max("wm_yr_wk")).first()
    if weeks[0] is None:
        return prices.where(F.lit(False))
    return prices.where(F.col("wm_yr_wk").between(weeks[0], weeks[1]))


def _every(value: str) -> bool:
    return True


def run_silver(spark: SparkSession, cfg: PipelineConfig, run_dates: Sequence[dt.date]) -> list[str]:
    """Build and publish the silver partitions of some days, from one snapshot of bronze and the dimensions.

    Tails that cover one of the days go in the same step, so a tail that exists always agrees with silver.
    """
    labels = [day_label(day, cfg.base_date) for day in run_dates]
    at = snapshot_of(spark, cfg.table(BRONZE))
    bronze = read_days(spark, cfg.table(BRONZE), BRONZE_SCHEMA, run_dates, at)
    calendar = read_table(spark, cfg.table(CALENDAR), CALENDAR_SCHEMA, at)
    prices = prices_for(read_table(spark, cfg.table(PRICES), PRICE_SCHEMA, at), calendar, labels)
    rules = silver_rules(single_date=len(set(run_dates)) == 1)
    rows = conform_columns(silver(bronze, calendar, prices, cfg.now(), cfg.version), SILVER_SCHEMA, "silver")
    batch = Batch(
        rows, cfg.table(SILVER), "run_date", None, ("item_id", "store_id"), tuple(day.isoformat() for day in run_dates),
        rules=tuple(rules), layer="silver",
    )
    wanted = {day.isoformat() for day in run_dates}
    relied = {cfg.table(BRONZE): wanted.__contains__, cfg.table(CALENDAR): _every, cfg.table(PRICES): _every}
    return publish([batch], at, {cfg.table(TAIL): days_from(spark, cfg.table(TAIL), min(run_dates), at)}, relied)[0]
