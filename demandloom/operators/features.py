"""Lag, rolling and calendar features per series.

A series is one item in one store with at most one row per day (the silver grain check rejects anything else
before it is published), so a window partition is bounded by the number of days, whatever the table size. All
eleven window columns share one shuffle on the series and one sort on the date.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from demandloom.functions.scalars import (
    is_cold_start, is_weekend, lag_or_mean, null_default, quarter, rolling_or_zero,
)
from demandloom.schemas import DATE_COLUMN, GOLD_COLUMNS, LAGS, SERIES_KEY, SNAP_COLUMNS, TARGET, WINDOWS


def series_window() -> WindowSpec:
    return Window.partitionBy(*SERIES_KEY).orderBy(DATE_COLUMN)


def lag_columns(lags: Sequence[int] = LAGS) -> dict[str, Column]:
    """Sales k rows back (rows, not days: a missing date shifts the lag)."""
    return {f"sales_lag_{k}": F.lag(TARGET, k).over(series_window()) for k in lags}


def rolling_mean_columns(windows: Sequence[int] = WINDOWS) -> dict[str, Column]:
    """Mean over the n rows before the current one."""
    return {f"sales_roll_mean_{n}": F.avg(TARGET).over(series_window().rowsBetween(-n, -1)) for n in windows}


def rolling_std_columns(windows: Sequence[int] = WINDOWS) -> dict[str, Column]:
    """Sample deviation over the same frames; a single row has none."""
    return {f"sales_roll_std_{n}": F.stddev_samp(TARGET).over(series_window().rowsBetween(-n, -1)) for n in windows}


def fallback_window(lag: int, windows: Sequence[int] = WINDOWS) -> int:
    """The window that stands in for a missing lag: the smallest one that covers it."""
    return next((n for n in sorted(windows) if n >= lag), max(windows))


def fill_lags(df: DataFrame, lags: Sequence[int] = LAGS, windows: Sequence[int] = WINDOWS) -> DataFrame:
    return df.withColumns(
        {f"sales_lag_{k}": lag_or_mean(f"sales_lag_{k}", f"sales_roll_mean_{fallback_window(k, windows)}") for k in lags}
    )


def fill_rolling(df: DataFrame, windows: Sequence[int] = WINDOWS) -> DataFrame:
    names = [f"sales_roll_{kind}_{n}" for n in windows for kind in ("mean", "std")]
    return df.withColumns({name: rolling_or_zero(name) for name in names})


def add_calendar_features(df: DataFrame) -> DataFrame:
    return df.withColumns({"is_weekend": is_weekend("date"), "quarter": quarter("date")})


def add_cold_start(df: DataFrame, first_day: dt.date | DataFrame | None = None) -> DataFrame:
    """Flag rows in the first 28 days of the whole history.

    A table knows its first day from its partition names; pass it, or a one-row ``_first_day``, to save the scan. Without it the minimum is
    computed as a one-row side and joined in.
    """
    if isinstance(first_day, dt.date):
        return df.withColumn("is_cold_start", is_cold_start(DATE_COLUMN, F.lit(first_day)))
    first = df.agg(F.min(DATE_COLUMN).alias("_first_day")) if first_day is None else first_day
    return (
        df.crossJoin(F.broadcast(first))
        .withColumn("is_cold_start", is_cold_start(DATE_COLUMN, "_first_day"))
        .drop("_first_day")
    )


def gold(
    silver: DataFrame,
    first_day: dt.date | DataFrame | None = None,
    lags: Sequence[int] = LAGS,
    windows: Sequence[int] = WINDOWS,
) -> DataFrame:
    """Every gold row of the given history in one pass.

    For one date, give the history up to that date and filter the result: the filter must stay above the windows.
    """
    based = add_cold_start(silver, first_day)
    history = lag_columns(lags) | rolling_mean_columns(windows) | rolling_std_columns(windows)
    filled = fill_rolling(fill_lags(based.withColumns(history), lags, windows), windows)
    flags = {name: null_default(name) for name in SNAP_COLUMNS}
    return add_calendar_features(filled).withColumns(flags).select(*GOLD_COLUMNS)
