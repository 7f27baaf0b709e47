"""Scalar column expressions used by the layers."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from demandloom.schemas import COLD_START_DAYS


def _column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def day_id(day: str | Column, base: dt.date) -> Column:
    """``d_<n>`` with the base date as day 1; a date before the base date raises when the row is read."""
    number = F.datediff(_column(day), F.lit(base)) + 1
    problem = F.concat(_column(day).cast("string"), F.lit(f" is before the first day {base.isoformat()}"))
    return F.when(number > 0, F.concat(F.lit("d_"), number.cast("string"))).otherwise(
        F.raise_error(problem).cast("string")
    )


def day_date(day: str | Column, base: dt.date) -> Column:
    """The date behind a ``d_<n>`` label."""
    number = F.substring_index(_column(day), "_", -1).cast("int")
    return F.date_add(F.lit(base), number - 1)


def day_label(day: dt.date, base: dt.date) -> str:
    """``day_id`` for one date known to the driver."""
    number = (day - base).days + 1
    if number <= 0:
        raise ValueError(f"{day.isoformat()} is before the first day {base.isoformat()}")
    return f"d_{number}"


def safe_double(text: str | Column) -> Column:
    """Text to double; malformed text and NaN become null.

    The cast alone would also take a Java literal suffix such as ``1d``, which is malformed here.
    """
    source = _column(text)
    number = source.try_cast("double")
    suffixed = source.cast("string").rlike("[0-9.][dDfF]\\s*$")
    return F.when(~suffixed & ~F.isnan(number), number)


def safe_int(text: str | Column) -> Column:
    """Text to int by way of double: malformed, missing, NaN and what no int holds become 0,
    fractions are cut off."""
    return F.coalesce(safe_double(text).try_cast("int"), F.lit(0))


def safe_date(text: str | Column) -> Column:
    """Text to date; anything malformed becomes null."""
    return _column(text).try_cast("date")


def sentinel_null(text: str | Column, sentinel: str = "NaN") -> Column:
    return F.nullif(_column(text), F.lit(sentinel))


def null_default(value: str | Column, default: int = 0) -> Column:
    return F.coalesce(_column(value), F.lit(default))


def is_weekend(day: str | Column) -> Column:
    return F.when(F.dayofweek(_column(day)).isin(1, 7), 1).otherwise(0)


def quarter(day: str | Column) -> Column:
    return F.quarter(_column(day))


def is_cold_start(day: str | Column, first_day: str | Column) -> Column:
    return F.coalesce(_column(day) < F.date_add(_column(first_day), COLD_START_DAYS), F.lit(False))


def lag_or_mean(lag: str | Column, mean: str | Column) -> Column:
    """A missing lag takes the window mean, then 0; kept whole, halves away from zero as the table stores it."""
    return F.round(F.coalesce(_column(lag).cast("double"), _column(mean), F.lit(0.0))).cast("int")


def rolling_or_zero(value: str | Column) -> Column:
    return F.round(F.coalesce(_column(value), F.lit(0.0)), 4)


def fingerprint(parts: Sequence[str | Column]) -> Column:
    """SHA-256 over named parts in sorted order, so that the order of writing them does not matter."""
    joined = F.array_join(F.array_sort(F.array(*[_column(part).cast("string") for part in parts])), "|")
    return F.sha2(joined, 256)
