"""Sales joined with calendar and prices."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom.functions.scalars import null_default, sentinel_null
from demandloom.schemas import CALENDAR_COLUMNS, EVENT_COLUMNS, EVENT_TYPE_COLUMNS, SILVER_COLUMNS, SNAP_COLUMNS

def join_calendar(bronze: DataFrame, calendar: DataFrame) -> DataFrame:
    """Inner join on the day label; sales of a day the calendar lacks are dropped."""
    return bronze.join(calendar.select(*CALENDAR_COLUMNS), "d")


def join_prices(sales: DataFrame, prices: DataFrame) -> DataFrame:
    """Left join on store, item and the calendar's week; AQE splits a hot key's rows."""
    return sales.join(
        prices.select("store_id", "item_id", "wm_yr_wk", "sell_price"), ["store_id", "item_id", "wm_yr_wk"], "left"
    )


def stamp(df: DataFrame, clock: dt.datetime | Column, version: str) -> DataFrame:
    """Processing time and version of the batch."""
    when = clock if isinstance(clock, Column) else F.lit(clock)
    return df.withColumns({"_processed_time": when.cast("timestamp"), "_pipeline_version": F.lit(version)})


def clean_events(df: DataFrame, names_too: bool = True) -> DataFrame:
    """The text ``NaN`` in the event columns becomes null; ``names_too=False`` leaves the event names as read."""
    columns = EVENT_COLUMNS if names_too else EVENT_TYPE_COLUMNS
    return df.withColumns({name: sentinel_null(name) for name in columns})


def silver(
    bronze: DataFrame,
    calendar: DataFrame,
    prices: DataFrame,
    clock: dt.datetime | Column,
    version: str = "v1",
    names_too: bool = True,
) -> DataFrame:
    """Bronze sales with the day's calendar row and the week's price."""
    joined = join_prices(join_calendar(bronze.drop("_pipeline_version"), calendar), prices)
    cleaned = clean_events(stamp(joined, clock, version), names_too)
    flags = {name: null_default(name) for name in SNAP_COLUMNS}
    return cleaned.withColumns(flags).select(*SILVER_COLUMNS)
