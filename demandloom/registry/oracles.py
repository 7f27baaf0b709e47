"""The same queries as SQL over the given tables.

Common views come first as one ``WITH`` list; each query adds its own body.
"""

from __future__ import annotations

ORACLES: dict[str, str] = {}

# Fixed values shared with the Spark side.
BASE = "DATE '1995-01-02'"
RUN_DATE = "DATE '1998-06-01'"
WINDOW_START, WINDOW_END = "DATE '2000-06-30'", "DATE '2001-06-30'"
TRAIN_END, VAL_END = "DATE '2001-03-12'", "DATE '2001-05-06'"
CLOCK = "TIMESTAMP '2002-01-01 00:00:00'"
LAGS, WINDOWS = (1, 3, 7, 14, 28), (7, 14, 28)
LAG_COLUMNS = [f"sales_lag_{k}" for k in LAGS]
MEAN_COLUMNS = [f"sales_roll_mean_{n}" for n in WINDOWS]
STD_COLUMNS = [f"sales_roll_std_{n}" for n in WINDOWS]
EVENTS = ["event_name_1", "event_type_1", "event_name_2", "event_type_2"]
SNAPS = ["snap_ca", "snap_tx", "snap_wi"]
CATEGORICAL = ["item_id", "store_id", "dept_id", "cat_id", "state_id", *EVENTS]
MODEL_COLUMNS = [
    "item_id", "store_id", "dept_id", "cat_id", "state_id", "d", "sales", "sell_price", "run_date",
    "_processed_time", "_pipeline_version", *LAG_COLUMNS, *MEAN_COLUMNS, *STD_COLUMNS, "is_cold_start",
    "is_weekend", "quarter", "month", "wday", "weekday", "year", *EVENTS, *SNAPS, "wm_yr_wk",
]
DROPPED = ["d", "_pipeline_version", "_processed_time", "weekday"]
FEATURES = [name for name in MODEL_COLUMNS if name not in [*DROPPED, "sales", "run_date"]]

_WINDOW = "PARTITION BY item_id, store_id ORDER BY run_date"
_RAW = ",\n".join(
    [f"lag(sales, {k}) OVER ({_WINDOW}) AS raw_lag_{k}" for k in LAGS]
    + [f"avg(sales) OVER ({_WINDOW} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING) AS raw_mean_{n}" for n in WINDOWS]
    + [
        f"stddev_samp(sales) OVER ({_WINDOW} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING) AS raw_std_{n}"
        for n in WINDOWS
    ]
)
_STAND_IN = {1: 7, 3: 7, 7: 7, 14: 14, 28: 28}
_LAGS_FILLED = [
    f"CAST(round(coalesce(CAST(raw_lag_{k} AS DOUBLE), raw_mean_{_STAND_IN[k]}, 0)) AS INTEGER) AS sales_lag_{k}"
    for k in LAGS
]
_ROLLS_FILLED = [
    f"round(coalesce(raw_{kind}_{n}, 0), 4) AS sales_roll_{kind}_{n}" for kind in ("mean", "std") for n in WINDOWS
]


def _gold(source: str) -> str:
    return f"""
SELECT item_id, store_id, dept_id, cat_id, state_id, d, sales, sell_price, run_date, _processed_time,
    _pipeline_version, wday, weekday, month, year, wm_yr_wk, {", ".join(_LAGS_FILLED + _ROLLS_FILLED)},
    CASE WHEN dayofweek(date) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
    CAST(quarter(date) AS INTEGER) AS quarter, {", ".join(EVENTS)}, {", ".join(SNAPS)},
    run_date < (SELECT min(run_date) FROM {source}) + 28 AS is_cold_start
FROM (SELECT *, {_RAW} FROM {source}) AS windowed"""


VIEWS = f"""
WITH sold AS (
    SELECT p_brand AS item_id, n_name AS store_id, r_name AS state_id, CAST(l_shipdate AS DATE) AS run_date,
        l_quantity, p_retailprice
    FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
    JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
), daily AS (
    SELECT item_id, store_id, state_id, run_date, CAST(sum(l_quantity) AS INTEGER) AS sales,
        CAST(floor((CAST(substr(item_id, 7) AS INTEGER) - 1) / 5.0) AS INTEGER) + 1 AS dept
    FROM sold GROUP BY item_id, store_id, state_id, run_date
), sales_daily AS (
    SELECT item_id, store_id, 'DEPT_' || dept AS dept_id,
        'CAT_' || (CAST(floor((dept - 1) / 2.0) AS INTEGER) + 1) AS cat_id, state_id,
        'd_' || (run_date - {BASE} + 1) AS d, sales, run_date, 'v1' AS _pipeline_version
    FROM daily
), days AS (
    SELECT DISTINCT CAST(l_shipdate AS DATE) AS date FROM lineitem
), calendar AS (
    SELECT 'd_' || (date - {BASE} + 1) AS d, date,
        CAST(10000 + floor((date - {BASE}) / 7.0) AS INTEGER) AS wm_yr_wk, dayname(date) AS weekday,
        CAST((dayofweek(date) + 1) % 7 + 1 AS INTEGER) AS wday, CAST(month(date) AS INTEGER) AS month,
        CAST(year(date) AS INTEGER) AS year,
        CASE WHEN month(date) = 12 AND day(date) = 25 THEN 'Christmas'
            WHEN month(date) = 7 AND day(date) = 4 THEN 'IndependenceDay'
            WHEN month(date) = 2 AND day(date) = 14 THEN 'ValentinesDay' ELSE 'NaN' END AS event_name_1,
        CASE WHEN month(date) = 12 AND day(date) = 25 THEN 'National'
            WHEN month(date) = 7 AND day(date) = 4 THEN 'National'
            WHEN month(date) = 2 AND day(date) = 14 THEN 'Cultural' ELSE 'NaN' END AS event_type_1,
        CASE WHEN month(date) = 2 AND day(date) = 14 AND year(date) % 2 = 0
            THEN 'OrthodoxEaster' ELSE 'NaN' END AS event_name_2,
        CASE WHEN month(date) = 2 AND day(date) = 14 AND year(date) % 2 = 0
            THEN 'Religious' ELSE 'NaN' END AS event_type_2,
        CASE WHEN day(date) <= 10 THEN 1 ELSE 0 END AS snap_ca,
        CASE WHEN day(date) = 31 THEN NULL WHEN day(date) % 2 = 0 THEN 1 ELSE 0 END AS snap_tx,
        CASE WHEN day(date) % 5 = 0 THEN 1 ELSE 0 END AS snap_wi
    FROM days
), sell_prices AS (
    SELECT store_id, item_id, wm_yr_wk, max(p_retailprice) AS sell_price
    FROM (SELECT *, CAST(10000 + floor((run_date - {BASE}) / 7.0) AS INTEGER) AS wm_yr_wk FROM sold) AS priced
    WHERE wm_yr_wk % 10 <> 0 GROUP BY store_id, item_id, wm_yr_wk
), silver AS (
    SELECT b.run_date, {CLOCK} AS _processed_time, 'v1' AS _pipeline_version, b.store_id, b.item_id, b.d, c.date,
        b.dept_id, b.cat_id, b.state_id, b.sales, p.sell_price, c.wm_yr_wk, c.weekday, c.wday, c.month, c.year,
        {", ".join(f"nullif(c.{name}, 'NaN') AS {name}" for name in EVENTS)},
        {", ".join(f"coalesce(c.{name}, 0) AS {name}" for name in SNAPS)}
    FROM sales_daily AS b JOIN calendar AS c ON b.d = c.d
    LEFT JOIN sell_prices AS p
        ON b.store_id = p.store_id AND b.item_id = p.item_id AND c.wm_yr_wk = p.wm_yr_wk
), gold AS ({_gold("silver")}
), split_rows AS (
    SELECT *, CASE WHEN run_date <= {TRAIN_END} THEN 'train' WHEN run_date <= {VAL_END} THEN 'val'
        ELSE 'test' END AS split
    FROM gold WHERE run_date BETWEEN {WINDOW_START} AND {WINDOW_END}
), cells AS (
    {" UNION ALL ".join(
        f"SELECT DISTINCT '{name}' AS column_name, {name} AS value FROM split_rows WHERE split = 'train' AND {name} IS NOT NULL"
        for name in CATEGORICAL)}
), vocabulary AS (
    SELECT column_name, value,
        CAST(row_number() OVER (PARTITION BY column_name ORDER BY value) - 1 AS INTEGER) AS code FROM cells
), predictions AS (
    SELECT sales_roll_mean_7 AS prediction, CAST(sales_lag_7 AS DOUBLE) AS baseline_prediction,
        CAST(sales AS DOUBLE) AS sales, store_id, dept_id FROM gold
), dirty_silver AS (
    SELECT * REPLACE (
        CASE WHEN wday = 3 THEN -sales ELSE sales END AS sales,
        CASE WHEN month = 2 THEN wday + 7 ELSE wday END AS wday,
        nullif(dept_id, 'DEPT_3') AS dept_id, snap_ca + snap_wi AS snap_ca,
        CASE WHEN event_type_1 = 'National' THEN 'Civic' ELSE event_type_1 END AS event_type_1)
    FROM silver
), dirty_gold AS ({_gold("dirty_silver")}
), etl_runs AS (
    SELECT o_orderkey AS run_id, o_orderpriority AS dag_id, CAST(o_orderdate AS DATE) AS run_date,
        CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'P' THEN 'failed' ELSE 'running' END AS status,
        o_orderdate AS created_at
    FROM orders
), etl_steps AS (
    SELECT l_orderkey AS run_id,
        CASE WHEN l_linenumber = 1 THEN 'bronze' WHEN l_linenumber = 2 THEN 'silver' ELSE 'gold' END AS step_name,
        CASE WHEN bool_or(l_returnflag = 'R' AND l_linestatus = 'O') THEN 'failed' ELSE 'success' END AS status,
        count(*) AS input_rows, CAST(sum(l_quantity) AS BIGINT) AS output_rows
    FROM lineitem GROUP BY 1, 2
), known_runs AS (
    SELECT o_orderpriority AS dag_id, CAST(o_orderdate AS DATE) AS run_date, min(o_orderkey) AS run_id,
        'success' AS status, 'scheduler' AS triggered_by, 'code ' || count(*) AS error_message,
        count(*) AS rows_gold
    FROM orders WHERE o_orderstatus = 'F' GROUP BY 1, 2
), rerun_requests AS (
    SELECT o_orderpriority AS dag_id, CAST(o_orderdate AS DATE) AS run_date, min(o_orderkey) AS run_id,
        'running' AS status, 'manual' AS triggered_by, CAST(NULL AS VARCHAR) AS error_message,
        count(*) AS rows_gold
    FROM orders WHERE o_orderstatus <> 'F' GROUP BY 1, 2
)
"""


def oracle(name: str, body: str) -> None:
    ORACLES[name] = f"{VIEWS}{body.strip()}"


def _report(source: str, layer: str, rules: list[tuple[str, str]], severity: str = "critical") -> str:
    """One row per rule; each rule is a name and an aggregate that counts failures."""
    counts = ", ".join(f"CAST({failed} AS BIGINT) AS f{i}" for i, (_, failed) in enumerate(rules))
    rows = " UNION ALL ".join(
        f"SELECT '{layer}' AS layer, '{name}' AS rule, '{severity}' AS severity, coalesce(f{i}, 0) AS failed_rows, "
        f"total_rows, coalesce(f{i}, 0) = 0 AS passed FROM counted"
        for i, (name, _) in enumerate(rules)
    )
    return f"SELECT * FROM (WITH counted AS (SELECT count(*) AS total_rows, {counts} FROM {source}) {rows}) AS report"


def _fails(condition: str) -> str:
    """Rows where the condition is false or null."""
    return f"count(*) FILTER (WHERE NOT coalesce({condition}, FALSE))"


def _not_null(names: list[str]) -> list[tuple[str, str]]:
    return [(f"not_null({name})", _fails(f"{name} IS NOT NULL")) for name in names]


def _at_least(name: str, bound: int) -> tuple[str, str]:
    return f"at_least({name},{bound})", _fails(f"{name} IS NULL OR {name} >= {bound}")


def _in_range(name: str, low: int, high: int) -> tuple[str, str]:
    return f"in_range({name},{low},{high})", _fails(f"{name} IS NULL OR {name} BETWEEN {low} AND {high}")


def _one_of(name: str, values: list, nullable: bool = False) -> tuple[str, str]:
    listed = ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)
    if nullable:
        return f"one_of_or_null({name})", _fails(f"{name} IS NULL OR {name} IN ({listed})")
    return f"one_of({name})", _fails(f"{name} IN ({listed})")


def _batch(name: str, condition: str) -> tuple[str, str]:
    return name, f"CASE WHEN {condition} THEN 0 ELSE 1 END"


SILVER_NOT_NULL = [
    "run_date", "_processed_time", "_pipeline_version", "store_id", "item_id", "d", "date", "dept_id", "cat_id",
    "state_id", "sales", "wm_yr_wk", "weekday", "wday", "month", "year", *SNAPS,
]
SILVER_BOUNDS = [_at_least("sales", 0), _at_least("sell_price", 0), _in_range("wday", 1, 7), _in_range("month", 1, 12)]
SILVER_FLAGS = [_one_of(name, [0, 1]) for name in SNAPS]
ML_SOFT = [
    *[_batch(f"cold_start_missing({name})",
             f"avg(CASE WHEN is_cold_start THEN CASE WHEN {name} IS NULL THEN 1 ELSE 0 END END) > 0.5")
      for name in LAG_COLUMNS],
    *[_batch(f"varies({name})", f"stddev_samp({name}) > 0") for name in [*LAG_COLUMNS, *MEAN_COLUMNS]],
    _batch("priced(sell_price)",
           "avg(CASE WHEN sales > 0 THEN CASE WHEN sell_price IS NOT NULL THEN 1 ELSE 0 END END) > 0.95"),
    _batch("p99(sales)", "quantile_cont(sales, 0.99) < 1000"),
]
ML_CRITICAL = [
    _batch("mean_positive(sales)", "avg(sales) > 0"),
    _batch("std_positive(sales)", "stddev_samp(sales) > 0"),
    *[_at_least(name, 0) for name in [*LAG_COLUMNS, *MEAN_COLUMNS, *STD_COLUMNS]],
]
WINDOW_ROWS = f"(SELECT * FROM gold WHERE run_date BETWEEN {WINDOW_START} AND {WINDOW_END}) AS window_rows"

# ---- sources and sinks ---------------------------------------------------------------------------------------

_SERIES = "(SELECT DISTINCT item_id, store_id, dept_id, cat_id, state_id FROM sales_daily) AS series"
_RUN_DAY = f"d_' || ({RUN_DATE} - {BASE} + 1)"

oracle("wide_slice", f"""
SELECT item_id, store_id, dept_id, cat_id, state_id, '{_RUN_DAY} AS d, coalesce(b.sales, 0) AS sales,
    {RUN_DATE} AS run_date, 'v1' AS _pipeline_version
FROM {_SERIES} LEFT JOIN (SELECT item_id, store_id, sales FROM sales_daily WHERE run_date = {RUN_DATE}) AS b
    USING (item_id, store_id)""")

oracle("wide_unpivot", f"""
SELECT item_id, 'd_' || n AS d, {BASE} + CAST(n - 1 AS INTEGER) AS run_date, series,
    CAST(coalesce(sales, 0) AS BIGINT) AS sales
FROM (SELECT item_id, count(*) AS series FROM {_SERIES} GROUP BY item_id) AS items
CROSS JOIN (SELECT unnest(range(1, (SELECT max(run_date) - {BASE} + 2 FROM sales_daily))) AS n) AS numbers
LEFT JOIN (SELECT item_id, run_date - {BASE} + 1 AS n, sum(sales) AS sales FROM sales_daily GROUP BY 1, 2) AS sold_days
    USING (item_id, n)""")

oracle("calendar_load", f"""
SELECT d, date, wm_yr_wk, weekday, wday, month, year, {", ".join(EVENTS)},
    {", ".join(f"coalesce({name}, 0) AS {name}" for name in SNAPS)} FROM calendar""")

oracle("prices_load", """
SELECT store_id, item_id, wm_yr_wk, CASE WHEN wm_yr_wk % 10 <> 5 THEN round(sell_price, 4) END AS sell_price
FROM sell_prices""")

oracle("scan_partition", f"""
SELECT item_id, store_id, dept_id, cat_id, state_id, d, sales, run_date, _pipeline_version FROM sales_daily
WHERE run_date = {RUN_DATE}""")
oracle("scan_history", f"SELECT item_id, store_id, run_date, sales FROM sales_daily WHERE run_date <= {RUN_DATE}")
oracle("scan_between", f"""
SELECT item_id, store_id, run_date, sales FROM sales_daily
WHERE run_date BETWEEN {WINDOW_START} AND {WINDOW_END}""")
oracle("scan_required_cols", "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem")
oracle("libsvm_roundtrip", "SELECT l_quantity AS label, l_extendedprice, l_discount, l_tax FROM lineitem")

oracle("partition_overwrite", f"""
SELECT item_id, store_id, dept_id, cat_id, state_id, d,
    CASE WHEN run_date >= {RUN_DATE} THEN sales + 1 ELSE sales END AS sales, run_date,
    CASE WHEN run_date >= {RUN_DATE} THEN 'v2' ELSE 'v1' END AS _pipeline_version
FROM sales_daily""")
oracle("dimension_overwrite", "SELECT store_id, item_id, wm_yr_wk, sell_price * 2 AS sell_price FROM sell_prices")
oracle("publish_if_valid", "SELECT *, 2 AS refused FROM sales_daily")
oracle("bronze_run", f"""
SELECT item_id, store_id, dept_id, cat_id, state_id, '{_RUN_DAY} AS d,
    CASE WHEN coalesce(b.sales, 0) % 5 IN (1, 3) THEN 0 ELSE coalesce(b.sales, 0) END AS sales,
    {RUN_DATE} AS run_date, 'v1' AS _pipeline_version, (SELECT count(*) FROM calendar) AS calendar_rows,
    (SELECT CAST(sum(coalesce(snap_tx, 0)) AS BIGINT) FROM calendar) AS snap_days, (SELECT count(*) FROM sell_prices) AS price_rows,
    (SELECT count(*) FROM sell_prices WHERE wm_yr_wk % 10 <> 5) AS readable_prices
FROM {_SERIES} LEFT JOIN (SELECT item_id, store_id, sales FROM sales_daily WHERE run_date = {RUN_DATE}) AS b
    USING (item_id, store_id)""")
oracle("split_sink", "SELECT item_id, store_id, run_date, sales, sell_price, split FROM split_rows")

_SCHEMA_HASH = f"sha256('columns={','.join(MODEL_COLUMNS)}')"
_FEATURE_HASH = f"sha256('feature_version=v1|features={','.join(FEATURES)}')"


def _dataset_id(day: str, rows: str) -> str:
    return (
        f"sha256('etl_run_id=1|feature_hash=' || {_FEATURE_HASH} || '|pipeline_name=demand_features|row_count=' || "
        f"{rows} || '|run_date=' || {day} || '|schema_hash=' || {_SCHEMA_HASH})"
    )


_COUNTS = ", ".join(
    f"count(*) FILTER (WHERE split = '{name}') AS {name}_row_count" for name in ("train", "val", "test")
)
oracle("dataset_metadata", f"""
SELECT train_row_count, val_row_count, test_row_count, total_row_count, {_SCHEMA_HASH} AS schema_hash,
    {_FEATURE_HASH} AS feature_hash, {_dataset_id(f"CAST({WINDOW_END} AS VARCHAR)", "total_row_count")} AS dataset_id,
    {WINDOW_START} AS dataset_start_date, {WINDOW_END} AS dataset_end_date, {len(FEATURES)} AS feature_count
FROM (SELECT {_COUNTS}, count(*) AS total_row_count FROM split_rows) AS counted""")

# ---- scalar functions ----------------------------------------------------------------------------------------

oracle("day_index", f"""
SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS run_date,
    'd_' || (CAST(l_shipdate AS DATE) - {BASE} + 1) AS d FROM lineitem""")
oracle("bronze_project", "SELECT * REPLACE ('v7' AS _pipeline_version) FROM sales_daily")

_TEXT = """CASE WHEN l_returnflag = 'A' THEN CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || '.9'
    WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN CAST(CAST(l_quantity AS INTEGER) AS VARCHAR)
    WHEN l_returnflag = 'N' THEN 'NaN' WHEN l_linestatus = 'F' THEN 'abc' ELSE '' END"""
oracle("safe_int", f"""
SELECT l_orderkey, l_linenumber, l_suppkey, raw,
    CASE WHEN try_cast(raw AS DOUBLE) IS NULL OR isnan(try_cast(raw AS DOUBLE)) THEN 0
        ELSE CAST(trunc(try_cast(raw AS DOUBLE)) AS INTEGER) END AS sales
FROM (SELECT *, {_TEXT} AS raw FROM lineitem) AS texts""")
oracle("stamp_columns", f"""
SELECT item_id, store_id, run_date, sales, {CLOCK} AS _processed_time, 'v3' AS _pipeline_version,
    {RUN_DATE} AS batch_date FROM sales_daily""")
oracle("sentinel_null", f"""
SELECT d, date, {", ".join(f"nullif({name}, 'NaN') AS {name}" for name in EVENTS)} FROM calendar""")
oracle("null_default", f"SELECT d, {', '.join(f'coalesce({name}, 0) AS {name}' for name in SNAPS)} FROM calendar")
oracle("lag_fallback", f"SELECT item_id, store_id, run_date, {', '.join(LAG_COLUMNS)} FROM gold")
oracle("rolling_default", f"SELECT item_id, store_id, run_date, {', '.join(MEAN_COLUMNS + STD_COLUMNS)} FROM gold")
oracle("date_parts", """
SELECT d, date, CASE WHEN dayofweek(date) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
    CAST(quarter(date) AS INTEGER) AS quarter FROM calendar""")
oracle("cold_start", "SELECT item_id, store_id, run_date, is_cold_start FROM gold")

_FLOATS = ["sales", "sell_price", *MEAN_COLUMNS, *STD_COLUMNS]


def _narrow(name: str) -> str:
    if name in _FLOATS:
        return f"CAST({name} AS FLOAT) AS {name}"
    if name == "is_cold_start":
        return f"CAST({name} AS TINYINT) AS {name}"
    return name


_NARROWED = ", ".join(_narrow(name) for name in MODEL_COLUMNS if name not in DROPPED)
oracle("narrow_types", f"SELECT {_NARROWED} FROM gold")
oracle("safe_date", """
SELECT o_orderkey, raw, try_cast(raw AS DATE) AS day
FROM (SELECT *, CASE o_orderstatus WHEN 'F' THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) WHEN 'O' THEN 'unknown'
    ELSE '1996-13-45' END AS raw FROM orders) AS texts""")


def _code(name: str) -> str:
    return (
        f"coalesce((SELECT code FROM vocabulary AS v WHERE v.column_name = '{name}' AND v.value = s.{name}), "
        f"(SELECT CAST(count(*) AS INTEGER) FROM vocabulary WHERE column_name = '{name}'))"
    )


def _cell(name: str) -> str:
    if name in CATEGORICAL:
        value = _code(name)
    elif name in _FLOATS:
        value = f"round(CAST(CAST(coalesce({name}, 0) AS FLOAT) AS DOUBLE), 4)"
    else:
        value = f"CAST(coalesce({name}, {'FALSE' if name == 'is_cold_start' else 0}) AS INTEGER)"
    return f"CAST({value} AS DOUBLE) AS f_{name}"


_CELLS = ", ".join(_cell(name) for name in FEATURES)
oracle("feature_vector", f"SELECT item_id, store_id, run_date, {_CELLS} FROM split_rows AS s")
oracle("dataset_libsvm", f"SELECT split, CAST(sales AS DOUBLE) AS label, {_CELLS} FROM split_rows AS s")
oracle("baseline_forecast", """
SELECT item_id, store_id, run_date, sales, CAST(sales_lag_7 AS DOUBLE) AS baseline_prediction, 'lag' AS kind FROM gold
UNION ALL
SELECT item_id, store_id, run_date, sales, round((SELECT avg(sales) FROM sales_daily), 6) AS baseline_prediction,
    'mean' AS kind FROM sales_daily""")
oracle("improvement_pct", """
SELECT store_id, round((baseline - model) / nullif(baseline, 0) * 100, 4) AS pct
FROM (SELECT store_id, avg(abs(sales - prediction)) AS model, avg(abs(sales - baseline_prediction)) AS baseline
    FROM predictions GROUP BY store_id) AS errors""")

# ---- filters and joins ---------------------------------------------------------------------------------------

oracle("status_gate", """
SELECT run_id, dag_id, run_date, status, 2 AS refused FROM etl_runs
WHERE run_id = (SELECT min(run_id) FROM etl_runs WHERE status = 'success')""")
oracle("silver_calendar_join", """
SELECT item_id, store_id, run_date, date, sales, wm_yr_wk, weekday, wday, month, year
FROM sales_daily JOIN calendar USING (d)""")
oracle("silver_price_join", "SELECT item_id, store_id, run_date, wm_yr_wk, sales, sell_price FROM silver")
oracle("silver_partition", "SELECT * FROM silver")
oracle("ordinal_encode", f"""
SELECT item_id AS item, store_id AS store, run_date, split,
    {", ".join(f"{_code(name)} AS {name}" for name in CATEGORICAL)} FROM split_rows AS s""")
oracle("latest_run", """
SELECT run_date, run_id, status FROM (
    SELECT *, row_number() OVER (PARTITION BY run_date ORDER BY created_at DESC, run_id DESC) AS place FROM etl_runs
) AS ranked WHERE place = 1""")

# ---- aggregations --------------------------------------------------------------------------------------------

oracle("table_count", f"""
SELECT count(*) AS rows, 'all' AS scope FROM sales_daily
UNION ALL SELECT count(*) AS rows, 'day' AS scope FROM sales_daily WHERE run_date = {RUN_DATE}""")
oracle("duplicate_grain", """
SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
oracle("split_counts", """
SELECT split, count(*) AS rows FROM split_rows GROUP BY split
UNION ALL SELECT 'total' AS split, count(*) AS rows FROM split_rows""")
oracle("vocabulary", 'SELECT column_name AS "column", value, code FROM vocabulary')


def _rmse(p: str) -> str:
    return f"sqrt(avg((sales - {p}) * (sales - {p})))"


def _wmape(p: str) -> str:
    return f"sum(abs(sales - {p})) / (sum(abs(sales)) + CAST(1e-8 AS DOUBLE))"


_OVERALL = f"""
SELECT {_rmse("prediction")} AS test_rmse, avg(abs(sales - prediction)) AS test_mae,
    {_wmape("prediction")} AS test_wmape,
    1 - sum((sales - prediction) * (sales - prediction)) / (var_pop(sales) * count(*)) AS test_r2,
    avg(sales - prediction) AS error_mean, stddev_samp(sales - prediction) AS error_std,
    {_rmse("baseline_prediction")} AS baseline_rmse, avg(abs(sales - baseline_prediction)) AS baseline_mae,
    {_wmape("baseline_prediction")} AS baseline_wmape, count(*) AS rows FROM predictions"""
_OVERALL_NAMES = [
    "test_rmse", "test_mae", "test_wmape", "test_r2", "error_mean", "error_std", "baseline_rmse", "baseline_mae",
    "baseline_wmape",
]
_IMPROVED = {
    "wmape_improvement_pct": "(baseline_wmape - test_wmape) / baseline_wmape * 100",
    "abs_error_improvement_pct": "(baseline_mae - test_mae) / baseline_mae * 100",
}
oracle("overall_metrics", f"""
SELECT {", ".join(f"round({name}, 6) AS {name}" for name in _OVERALL_NAMES)}, rows,
    {", ".join(f"round({value}, 6) AS {name}" for name, value in _IMPROVED.items())} FROM ({_OVERALL}) AS overall""")
oracle("baseline_metrics", f"""
SELECT round(baseline_rmse, 6) AS baseline_rmse, round(baseline_mae, 6) AS baseline_mae,
    round(baseline_wmape, 6) AS baseline_wmape, rows FROM ({_OVERALL}) AS overall""")


def _slices(names: tuple[str, ...] = ("store_id", "dept_id")) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS slice, {name} AS value, {_rmse('prediction')} AS rmse, avg(abs(sales - prediction)) AS mae, "
        f"{_wmape('prediction')} AS wmape, avg(sales - prediction) AS bias, count(*) AS rows FROM predictions GROUP BY {name}"
        for name in names
    )


_SPREAD = {
    "avg_wmape": "avg(wmape)", "best_wmape": "min(wmape)", "worst_wmape": "max(wmape)",
    "median_wmape": "median(wmape)", "p90_wmape": "quantile_cont(wmape, 0.9)",
}
oracle("slice_metrics", f"""
SELECT slice, value, round(rmse, 6) AS rmse, round(mae, 6) AS mae, round(wmape, 6) AS wmape, round(bias, 6) AS bias,
    rows FROM ({_slices()}) AS slices""")
oracle("slice_summary", f"""
SELECT slice, {", ".join(f"round({value}, 6) AS {name}" for name, value in _SPREAD.items())}
FROM ({_slices()}) AS slices GROUP BY slice""")
_MEASURES = ["rmse", "mae", "wmape", "bias", "rows"]


def _long(source: str, slice_text: str, values: dict[str, str], tail: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS metric, {slice_text} AS slice, CAST({value} AS DOUBLE) AS value FROM ({source}) AS t {tail}"
        for name, value in values.items()
    )


def _evaluation() -> str:
    """Every stored metric of ``predictions``: overall, per member of a slice, and the spread over members."""
    overall = {**{name: name for name in [*_OVERALL_NAMES, "rows"]}, **_IMPROVED}
    return " UNION ALL ".join([
        _long(_OVERALL, "'all'", overall), _long(_slices(), "slice || '=' || value", {name: name for name in _MEASURES}),
        _long(_slices(), "slice", _SPREAD, "GROUP BY slice"),
    ])


oracle("evaluate_run", f"SELECT metric, slice, round(value, 5) AS value FROM ({_evaluation()}) AS named_values")

_STAND_INS = ["sales_roll_mean_28", "sales_roll_mean_14", "sales_lag_7", "sales_lag_1"]
oracle("best_model", f"""
SELECT model AS best_model, round(wmape, 6) AS best_wmape FROM (
    {" UNION ALL ".join(
        f"SELECT '{name}{suffix}' AS model, {i + 1 + shift} AS priority, "
        f"sum(abs(sales - {name})) / (sum(abs(sales)) + CAST(1e-8 AS DOUBLE)) AS wmape FROM gold"
        for shift, suffix in ((0, ""), (4, "_again")) for i, name in enumerate(_STAND_INS))}
) AS candidates ORDER BY round(wmape, 12), priority DESC LIMIT 1""")
oracle("dataset_window", f"""
SELECT run_date, window_start,
    window_start + CAST(floor((run_date - window_start) * CAST(0.70 AS DOUBLE)) AS INTEGER) AS train_end,
    window_start + CAST(floor((run_date - window_start) * CAST(0.85 AS DOUBLE)) AS INTEGER) AS val_end
FROM (SELECT date AS run_date, greatest(date - 365, {BASE}) AS window_start FROM calendar) AS windows""")

# ---- windows -------------------------------------------------------------------------------------------------

_RAWS = f"(SELECT item_id, store_id, run_date, sales, {_RAW} FROM sales_daily) AS raws"
oracle("lag_features", f"""
SELECT item_id, store_id, run_date, sales, {", ".join(f"raw_lag_{k} AS sales_lag_{k}" for k in LAGS)} FROM {_RAWS}""")
oracle("rolling_mean", f"""
SELECT item_id, store_id, run_date, sales,
    {", ".join(f"round(raw_mean_{n}, 4) AS sales_roll_mean_{n}" for n in WINDOWS)} FROM {_RAWS}""")
oracle("rolling_std", f"""
SELECT item_id, store_id, run_date, sales,
    {", ".join(f"round(raw_std_{n}, 4) AS sales_roll_std_{n}" for n in WINDOWS)} FROM {_RAWS}""")
oracle("gold_partition", f"SELECT * FROM gold WHERE run_date = {RUN_DATE}")
oracle("gold_backfill", "SELECT * FROM gold")
oracle("dataset_order", """
SELECT split, item_id, store_id, run_date, sales,
    row_number() OVER (PARTITION BY split ORDER BY item_id, store_id, run_date) AS place
FROM split_rows""")
oracle("dedup_keep_first", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM (
    SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice) AS place FROM lineitem
) AS ranked WHERE place = 1""")

# ---- quality -------------------------------------------------------------------------------------------------

oracle("schema_contract", _report(
    f"(SELECT {_TEXT} AS sales FROM lineitem) AS texts", "bronze",
    [
        ("castable(d,string)", "0"),
        ("castable(sales,int)", _fails("regexp_full_match(sales, '[0-9]+')")),
        ("castable(run_date,date)", "0"),
    ],
))
oracle("rule_not_null", _report("dirty_silver", "silver", _not_null(SILVER_NOT_NULL)))
oracle("rule_bounds", _report("dirty_silver", "silver", SILVER_BOUNDS))
oracle("rule_domain", " UNION ALL ".join([
    _report("dirty_gold", "gold", [
        *SILVER_FLAGS, _one_of("state_id", ["AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]),
        *[_one_of(name, ["Sporting", "Cultural", "National", "Religious"], True) for name in ("event_type_1", "event_type_2")],
    ]),
    _report("etl_runs", "etl_pipeline_runs", [_one_of("status", ["success", "failed"])]),
]))
oracle("single_batch", _report("sales_daily", "bronze", [
    _batch(f"single_value({name})", f"count(DISTINCT {name}) = 1") for name in ("run_date", "_pipeline_version")
]))
oracle("rule_time_order", _report(
    "(SELECT run_date, TIMESTAMP '1998-06-01 00:00:00' AS _processed_time FROM sales_daily) AS stamped", "gold",
    [("not_before(_processed_time,run_date)", _fails("_processed_time >= run_date"))],
))
oracle("rule_foreign_key", " UNION ALL ".join([
    _report(
        "(SELECT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = run_id AND o_orderstatus = 'F') AS known FROM etl_steps) AS marked",
        "etl_pipeline_steps", [("references(run_id)", _fails("known"))],
    ),
    _report(
        "(SELECT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey) AS known FROM orders) AS marked",
        "orders", [("references(o_custkey)", _fails("known"))],
    ),
]))
oracle("ml_critical_checks", _report(WINDOW_ROWS, "dataset", ML_CRITICAL))
oracle("ml_soft_checks", _report(WINDOW_ROWS, "dataset", ML_SOFT, "soft"))
oracle("quality_report", f"""
SELECT *, layer = 'silver' AS refused,
    CASE WHEN passed THEN 'pass' WHEN severity = 'critical' THEN 'raise' ELSE 'warn' END AS action
FROM (
    {_report("dirty_silver", "silver", [*_not_null(SILVER_NOT_NULL), *SILVER_BOUNDS, *SILVER_FLAGS])}
    UNION ALL SELECT layer, rule, severity, failed_rows, (SELECT count(*) FROM dirty_silver) AS total_rows, passed FROM ({_report(
        "(SELECT count(*) AS n FROM dirty_silver GROUP BY run_date, store_id, item_id, d) AS grains", "silver",
        [("unique(run_date,store_id,item_id,d)", "count(*) FILTER (WHERE n > 1)")])}) AS unique_keys
    UNION ALL {_report(WINDOW_ROWS, "dataset", ML_SOFT, "soft")}
) AS all_rules""")

# ---- ledger --------------------------------------------------------------------------------------------------

oracle("upsert_update", """
SELECT dag_id, run_date, coalesce(k.run_id, r.run_id) AS run_id,
    CASE WHEN r.run_id IS NOT NULL THEN r.status ELSE k.status END AS status,
    CASE WHEN r.run_id IS NOT NULL THEN r.triggered_by ELSE k.triggered_by END AS triggered_by,
    CASE WHEN k.run_id IS NOT NULL AND r.run_id IS NOT NULL THEN NULL WHEN k.run_id IS NOT NULL THEN k.error_message
        ELSE r.error_message END AS error_message,
    CASE WHEN k.run_id IS NOT NULL AND r.run_id IS NOT NULL THEN 0 WHEN k.run_id IS NOT NULL THEN k.rows_gold
        ELSE r.rows_gold END AS rows_gold
FROM known_runs AS k FULL OUTER JOIN rerun_requests AS r USING (dag_id, run_date)""")
oracle("upsert_ignore", """
SELECT * FROM known_runs UNION ALL SELECT * FROM rerun_requests AS r
WHERE NOT EXISTS (SELECT 1 FROM known_runs AS k WHERE k.dag_id = r.dag_id AND k.run_date = r.run_date)""")
oracle("keyed_update", f"""
SELECT k.dag_id, k.run_date, k.run_id,
    CASE WHEN r.run_id IS NULL THEN k.status WHEN r.run_id % 3 = 0 THEN 'success' WHEN r.run_id % 3 = 1 THEN 'failed'
        ELSE 'running' END AS status, k.triggered_by, k.error_message, k.rows_gold,
    CASE WHEN r.run_id IS NULL THEN {CLOCK} - INTERVAL 1 DAY WHEN r.run_id % 3 < 2 THEN {CLOCK} END AS ended_at
FROM known_runs AS k LEFT JOIN rerun_requests AS r ON k.dag_id = r.dag_id AND k.run_date = r.run_date""")
oracle("run_outcome", """
SELECT run_id, CASE WHEN ok THEN 'success' ELSE 'failed' END AS status,
    CASE WHEN NOT ok THEN 'steps not all successful: bronze=' || coalesce(bronze, 'none') || ', silver='
        || coalesce(silver_state, 'none') || ', gold=' || coalesce(gold_state, 'none') END AS error_message
FROM (SELECT *, coalesce(bronze = 'success', FALSE) AND coalesce(silver_state = 'success', FALSE)
        AND coalesce(gold_state = 'success', FALSE) AS ok
    FROM (SELECT run_id, max(CASE WHEN step_name = 'bronze' THEN judged_state END) AS bronze,
            max(CASE WHEN step_name = 'silver' THEN judged_state END) AS silver_state,
            max(CASE WHEN step_name = 'gold' THEN judged_state END) AS gold_state
        FROM (SELECT l_orderkey AS run_id,
                CASE WHEN l_linenumber = 1 THEN 'bronze' WHEN l_linenumber = 2 THEN 'silver' ELSE 'gold' END AS step_name,
                CASE WHEN count(*) = count(*) FILTER (WHERE l_returnflag <> 'R' OR l_linestatus <> 'O') THEN 'success'
                    ELSE 'failed' END AS judged_state
            FROM lineitem GROUP BY 1, 2) AS steps
        GROUP BY run_id) AS wide) AS judged""")
oracle("step_metrics", f"""
SELECT run_id, {", ".join(
    f"CAST(coalesce(sum(CASE WHEN step_name = '{name}' THEN output_rows END), 0) AS BIGINT) AS rows_{name}"
    for name in ("bronze", "silver", "gold"))} FROM etl_steps GROUP BY run_id""")
oracle("cascade_delete", """
SELECT run_id, step_name, status, input_rows, output_rows FROM etl_steps
WHERE run_id NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')""")
oracle("lineage_view", """
SELECT r.run_id, 'ds_' || r.run_id AS dataset_id, s.step_name AS stage, r.dag_id AS pipeline_name, r.run_date,
    r.status AS run_status, d.total_row_count, 'features' AS feature_hash, 'schema' AS schema_hash,
    s.status AS stage_status, round(CAST(s.output_rows AS DOUBLE) / s.input_rows, 6) AS value
FROM etl_runs AS r
JOIN (SELECT l_orderkey AS run_id, count(*) AS total_row_count FROM lineitem GROUP BY 1) AS d USING (run_id)
LEFT JOIN etl_steps AS s USING (run_id)""")

# ---- datasets ------------------------------------------------------------------------------------------------

oracle("time_split", "SELECT item_id, store_id, run_date, split FROM split_rows")
oracle("fingerprints", f"""
SELECT run_date, rows, {_SCHEMA_HASH} AS schema_hash, {_FEATURE_HASH} AS feature_hash,
    sha256('feature_version=v1|pipeline_name=demand_features|run_date=' || run_date || '|run_id=1') AS build_id,
    {_dataset_id("run_date", "rows")} AS dataset_id
FROM (SELECT run_date, count(*) AS rows FROM sales_daily GROUP BY run_date) AS per_day""")
# A row as text: columns by name, fractions in whole ten-thousandths. Both 60-bit pieces of its MD5 are summed up.
_PRIMES = (2305843009213693951, 576460752303423433)
GOLD_COLUMNS = [name for name in MODEL_COLUMNS if name != "_processed_time"]
BRONZE_COLUMNS = ["item_id", "store_id", "dept_id", "cat_id", "state_id", "d", "sales", "run_date", "_pipeline_version"]
SILVER_COLUMNS = [name for name in [*SILVER_NOT_NULL, "sell_price", *EVENTS] if name != "_processed_time"]
_WHOLE_SALES = [name for name in _FLOATS if name != "sales"]


def _content(source: str, columns: list[str], fractions: list[str], by: str = "") -> str:
    def text(name: str) -> str:
        value = f"CAST(round(CAST({name} AS DOUBLE) * 10000) AS BIGINT)" if name in fractions else name
        return f"coalesce(CAST({value} AS VARCHAR), chr(30))"

    digest = f"md5(concat_ws(chr(31), {', '.join(text(name) for name in sorted(columns))}))"
    pieces = [f"('0x' || substr({digest}, {start}, 15))::BIGINT" for start in (1, 16)]
    sums = " || '-' || ".join(f"CAST(sum({piece}) % {prime} AS VARCHAR)" for piece, prime in zip(pieces, _PRIMES))
    head = f"{by}, " if by else ""
    return f"SELECT {head}count(*) AS rows, {sums} AS content_hash FROM {source}{f' GROUP BY {by}' if by else ''}"


oracle("content_fingerprint", _content("gold", GOLD_COLUMNS, _WHOLE_SALES, "run_date"))
_NARROW_ROWS = f"(SELECT {_NARROWED}, split FROM split_rows) AS narrow"
_KEPT = [name for name in MODEL_COLUMNS if name not in DROPPED]
oracle("build_dataset", f"""
SELECT {_dataset_id(f"CAST({WINDOW_END} AS VARCHAR)", "total_row_count")} AS dataset_id, '1' AS run_id,
    'demand_features' AS pipeline_name, 'gold_table' AS source_table, {WINDOW_START} AS dataset_start_date,
    {WINDOW_END} AS dataset_end_date, train_row_count, val_row_count, test_row_count, total_row_count,
    'v1' AS feature_version, {_FEATURE_HASH} AS feature_hash, {_SCHEMA_HASH} AS schema_hash,
    (SELECT content_hash FROM ({_content(_NARROW_ROWS, [*_KEPT, "split"], _FLOATS)}) AS hashed) AS content_hash
FROM (SELECT {_COUNTS}, count(*) AS total_row_count FROM split_rows) AS counted""")
oracle("dataset_publish", f"""
SELECT {", ".join(f"round(CAST({name} AS DOUBLE), 3) AS {name}" if name in _FLOATS else name for name in _KEPT)}, split
FROM {_NARROW_ROWS}""")
oracle("candidate_baseline", f"""
SELECT 'baseline_prediction' AS model, CAST(NULL AS INTEGER) AS priority, round({_rmse("p")}, 6) AS rmse,
    round({_wmape("p")}, 6) AS wmape, CAST(0 AS DOUBLE) AS improvement_pct
FROM (SELECT CAST(sales AS DOUBLE) AS sales, CAST(sales_lag_7 AS DOUBLE) AS p FROM split_rows WHERE split = 'val') AS held""")
oracle("batch_predict_rows", """
SELECT item_id, store_id, dept_id, run_date, CAST(sales AS DOUBLE) AS sales, CAST(sales_lag_7 AS DOUBLE) AS baseline_prediction
FROM split_rows WHERE split = 'test'""")

# ---- whole runs: every series on every day of the calendar, eight years (2922 days) later ----------------------

_RUN_VIEWS = f""", run_calendar AS (
    SELECT * REPLACE (date + 2922 AS date, dayname(date + 2922) AS weekday,
        CAST((dayofweek(date + 2922) + 1) % 7 + 1 AS INTEGER) AS wday, year + 8 AS year) FROM calendar
), run_bronze AS (
    SELECT s.item_id, s.store_id, s.dept_id, s.cat_id, s.state_id, c.d, coalesce(b.sales, 0) AS sales, c.date AS run_date,
        'v1' AS _pipeline_version
    FROM {_SERIES} AS s CROSS JOIN run_calendar AS c LEFT JOIN sales_daily AS b
        ON b.item_id = s.item_id AND b.store_id = s.store_id AND b.d = c.d
), run_silver AS (
    SELECT b.run_date, {CLOCK} AS _processed_time, b._pipeline_version, b.store_id, b.item_id, b.d, c.date, b.dept_id, b.cat_id,
        b.state_id, b.sales, p.sell_price, c.wm_yr_wk, c.weekday, c.wday, c.month, c.year,
        {", ".join(f"nullif(c.{name}, 'NaN') AS {name}" for name in EVENTS)},
        {", ".join(f"coalesce(c.{name}, 0) AS {name}" for name in SNAPS)}
    FROM run_bronze AS b JOIN run_calendar AS c ON b.d = c.d
    LEFT JOIN sell_prices AS p ON b.store_id = p.store_id AND b.item_id = p.item_id AND c.wm_yr_wk = p.wm_yr_wk
), run_gold AS ({_gold("run_silver")}
)
"""
_RUN_VIEWS = _RUN_VIEWS.replace(f"FROM {_SERIES} AS s", "FROM (SELECT DISTINCT item_id, store_id, dept_id, cat_id, state_id FROM sales_daily) AS s")


def run_oracle(name: str, body: str) -> None:
    ORACLES[name] = f"{VIEWS.rstrip()}{_RUN_VIEWS}{body.strip()}"


run_oracle("etl_run", """
SELECT CAST(1 AS BIGINT) AS run_id, 'demand_etl' AS dag_id, max(run_date) AS run_date, 'success' AS status,
    CAST(NULL AS VARCHAR) AS error_message, count(*) AS rows_bronze, (SELECT count(*) FROM run_silver) AS rows_silver,
    count(*) AS rows_gold
FROM run_bronze""")
run_oracle("etl_run_tables", " UNION ALL ".join(
    f"SELECT run_date, rows, content_hash, '{layer}' AS layer FROM ({_content(source, columns, _WHOLE_SALES, 'run_date')}) AS {source}_days"
    for layer, source, columns in (
        ("bronze_sales", "run_bronze", BRONZE_COLUMNS), ("silver_table", "run_silver", SILVER_COLUMNS), ("gold_table", "run_gold", GOLD_COLUMNS))
))
run_oracle("ml_run", f"""
SELECT '1' AS run_id, 'demand_features' AS pipeline_name, last_day AS run_date, 'success' AS run_status, total_row_count,
    stage, 'success' AS stage_status, metric, slice, round(value, 5) AS value
FROM (
    SELECT *, (SELECT max(run_date) FROM run_gold) AS last_day,
        (SELECT count(*) FROM run_gold WHERE run_date >= (SELECT max(run_date) FROM run_gold) - 365) AS total_row_count
    FROM (
        WITH tested AS (
            SELECT CAST(sales AS DOUBLE) AS sales, CAST(sales_lag_7 AS DOUBLE) AS baseline_prediction, store_id, dept_id FROM run_gold
            WHERE run_date > (SELECT max(run_date) FROM run_gold) - 365 + CAST(floor(365 * CAST(0.85 AS DOUBLE)) AS INTEGER)
        )
        SELECT 'predict' AS stage, 'prediction_rows' AS metric, 'all' AS slice, CAST(count(*) AS DOUBLE) AS value FROM tested
        UNION ALL SELECT 'evaluate', 'rows', 'all', count(*) FROM tested
        UNION ALL SELECT 'evaluate', 'rows', 'store_id=' || store_id, count(*) FROM tested GROUP BY store_id
        UNION ALL SELECT 'evaluate', 'rows', 'dept_id=' || dept_id, count(*) FROM tested GROUP BY dept_id
        UNION ALL SELECT 'evaluate', 'baseline_rmse', 'all', {_rmse("baseline_prediction")} FROM tested
        UNION ALL SELECT 'evaluate', 'baseline_mae', 'all', avg(abs(sales - baseline_prediction)) FROM tested
        UNION ALL SELECT 'evaluate', 'baseline_wmape', 'all', {_wmape("baseline_prediction")} FROM tested
    ) AS stored
) AS told""")
