"""Bronze: raw files into the sales table and its dimensions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import SparkSession

from demandloom.config import PipelineConfig
from demandloom.operators.rules import bronze_rules, calendar_rules, price_rules
from demandloom.operators.storage import Batch, publish
from demandloom.sources.csv import read_calendar, read_prices, read_wide_sales

BRONZE, CALENDAR, PRICES = "bronze_sales", "calendar", "sell_prices"


def run_bronze(
    spark: SparkSession,
    cfg: PipelineConfig,
    run_dates: Sequence[dt.date],
    sales_csv: str,
    calendar_csv: str | None = None,
    prices_csv: str | None = None,
) -> list[str]:
    """Load some days of sales and, when their files are given, replace the dimensions in the same load.

    Prices are laid out by week, so that a day's price lookup skips the files of other weeks.
    """
    sales = read_wide_sales(spark, sales_csv, cfg.base_date, run_dates, cfg.version)
    batches = [
        Batch(
            sales, cfg.table(BRONZE), "run_date", None, ("item_id", "store_id"),
            tuple(day.isoformat() for day in run_dates), rules=tuple(bronze_rules()), layer="bronze",
        )
    ]
    if calendar_csv is not None:
        days = read_calendar(spark, calendar_csv)
        batches.append(Batch(days, cfg.table(CALENDAR), rules=tuple(calendar_rules()), layer="calendar"))
    if prices_csv is not None:
        prices = read_prices(spark, prices_csv)
        batches.append(
            Batch(
                prices, cfg.table(PRICES), sort=("wm_yr_wk", "store_id", "item_id"), rules=tuple(price_rules()),
                layer="sell_prices",
            )
        )
    return publish(batches)[0]
