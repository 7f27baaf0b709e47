"""The rule sets of each layer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from demandloom.operators.quality import (
    SOFT, Rule, UniqueKey, at_least, batch, in_range, not_before, not_null, one_of, single_value,
)
from demandloom.schemas import (
    BRONZE_COLUMNS, BRONZE_KEY, CALENDAR_KEY, EVENT_COLUMNS, EVENT_TYPE_COLUMNS, GOLD_COLUMNS, GOLD_KEY, LAG_COLUMNS,
    MEAN_COLUMNS, PRICE_KEY, SILVER_COLUMNS, SILVER_KEY, SNAP_COLUMNS, STD_COLUMNS, TARGET,
)

# Bounds and domains of the layer contracts.
WDAY_RANGE = (1, 7)
MONTH_RANGE = (1, 12)
FIRST_YEAR = 2000
FLAGS = (0, 1)
COLD_START_NULL_SHARE = 0.5
PRICED_SHARE = 0.95
P99_LIMIT = 1000
GOLD_NULLABLE = {
    "sell_price", "weekday", "wday", "month", "year", *EVENT_COLUMNS, *LAG_COLUMNS, *MEAN_COLUMNS, *STD_COLUMNS,
    "is_weekend", "quarter",
}


def bronze_rules() -> list:
    return [*[not_null(name) for name in BRONZE_COLUMNS], at_least(TARGET, 0), UniqueKey(tuple(BRONZE_KEY))]


def calendar_rules() -> list:
    needed = ["d", "date", "wm_yr_wk", "weekday", "wday", "month", "year"]
    return [
        *[not_null(name) for name in needed], in_range("wday", *WDAY_RANGE), in_range("month", *MONTH_RANGE),
        *[one_of(name, FLAGS) for name in SNAP_COLUMNS], UniqueKey(tuple(CALENDAR_KEY)),
    ]


def price_rules() -> list:
    return [*[not_null(name) for name in PRICE_KEY], at_least("sell_price", 0), UniqueKey(tuple(PRICE_KEY))]


def silver_not_null() -> list[Rule]:
    return [not_null(name) for name in SILVER_COLUMNS if name != "sell_price" and name not in EVENT_COLUMNS]


def silver_rules(single_date: bool = True) -> list:
    """``single_date=False`` checks a batch of many dates: the key then includes the date."""
    grain = SILVER_KEY if single_date else ["run_date", *SILVER_KEY]
    rules = [
        *silver_not_null(), at_least(TARGET, 0), at_least("sell_price", 0), in_range("wday", *WDAY_RANGE),
        in_range("month", *MONTH_RANGE), *[one_of(name, FLAGS) for name in SNAP_COLUMNS], UniqueKey(tuple(grain)),
    ]
    return [*rules, single_value("run_date")] if single_date else rules


def gold_rules(states: Sequence[str], event_types: Sequence[str], single_date: bool = True) -> list:
    rules = [
        *[not_null(name) for name in GOLD_COLUMNS if name not in GOLD_NULLABLE], at_least(TARGET, 0),
        at_least("sell_price", 0), at_least("year", FIRST_YEAR), in_range("wday", *WDAY_RANGE),
        in_range("month", *MONTH_RANGE), *[one_of(name, FLAGS) for name in SNAP_COLUMNS], one_of("state_id", states),
        *[one_of(name, event_types, nullable=True) for name in EVENT_TYPE_COLUMNS],
        not_before("_processed_time", "run_date"), single_value("_pipeline_version"), UniqueKey(tuple(GOLD_KEY)),
    ]
    return [*rules, single_value("run_date")] if single_date else rules


def percentile_below(name: str, percent: int, limit: float) -> Column:
    """Whether the interpolated percentile lies under ``limit``, from sums, a maximum and a minimum alone.

    The values around the percentile's place are both under the limit, both not, or the largest under it and the
    smallest not under it; so no task ever holds all distinct values. Null without values.
    """
    value = F.col(name).cast("double")
    place = (F.count(value) - 1) * percent  # in hundredths
    before = F.floor(place / 100)
    share = (place - before * 100) / 100.0
    under = F.count(F.when(value < limit, value))
    low, high = F.max(F.when(value < limit, value)), F.min(F.when(value >= limit, value))
    between = low + share * (high - low) < limit
    return F.when(F.count(value) > 0, (under >= before + 2) | ((under == before + 1) & F.coalesce(between, F.lit(True))))


def ml_critical_rules() -> list[Rule]:
    """The target moves and no history feature is negative."""
    return [
        batch("mean_positive(sales)", F.avg(TARGET) > 0),
        batch("std_positive(sales)", F.stddev_samp(TARGET) > 0),
        *[at_least(name, 0) for name in [*LAG_COLUMNS, *MEAN_COLUMNS, *STD_COLUMNS]],
    ]


def ml_soft_rules() -> list[Rule]:
    """Warnings only. Filled lags make the cold-start rule warn on every gold batch; that is how it is meant."""
    cold = F.col("is_cold_start").cast("boolean")
    active = F.col(TARGET) > 0
    missing = lambda name: F.avg(F.when(cold, F.col(name).isNull().cast("int")))
    return [
        *[batch(f"cold_start_missing({name})", missing(name) > COLD_START_NULL_SHARE, SOFT) for name in LAG_COLUMNS],
        *[batch(f"varies({name})", F.stddev_samp(name) > 0, SOFT) for name in [*LAG_COLUMNS, *MEAN_COLUMNS]],
        batch(
            "priced(sell_price)",
            F.avg(F.when(active, F.col("sell_price").isNotNull().cast("int"))) > PRICED_SHARE, SOFT,
        ),
        batch("p99(sales)", percentile_below(TARGET, 99, P99_LIMIT), SOFT),
    ]


def status_rules(states: Sequence[str]) -> list[Rule]:
    return [one_of("status", states)]
