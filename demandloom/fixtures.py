"""Retail views over the given order tables: the same shapes the pipeline reads from its own files.

``sales_daily`` (bronze), ``calendar`` and ``sell_prices`` follow the definitions in FIXTURES.md; ``oracles``
holds the same three views as SQL.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from demandloom.config import PipelineConfig
from demandloom.operators.features import gold
from demandloom.operators.joins import silver
from demandloom.operators.storage import overwrite_partitions
from demandloom.schemas import BRONZE_SCHEMA, CALENDAR_COLUMNS, PRICE_COLUMNS, SALES_IDS
from demandloom.session import scratch_path
from demandloom.sources.tables import read_table

# Fixed values shared with the SQL side.
BASE = dt.date(1995, 1, 2)
RUN_DATE = dt.date(1998, 6, 1)
ML_RUN_DATE = dt.date(2001, 6, 30)
CLOCK = dt.datetime(2002, 1, 1)
VERSION = "v1"
SHIFT_YEARS = 8
SHIFTED_BASE = BASE.replace(year=BASE.year + SHIFT_YEARS)
STATES = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
EVENT_TYPES = ("Sporting", "Cultural", "National", "Religious")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _day() -> Column:
    return F.col("l_shipdate").cast("date")


def week_of(day: str | Column) -> Column:
    return (F.lit(10000) + F.floor(F.datediff(day, F.lit(BASE)) / 7)).cast("int")


def sold_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with item, store and state.

    Nation and region have 25 and 5 rows by definition. Part and supplier grow: they are joined straight from
    their files, so Catalyst sees their sizes and AQE splits a hot part or supplier once they are shuffled.
    """
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("p_partkey"), F.col("l_suppkey").alias("s_suppkey"), _day().alias("run_date"),
        "l_quantity",
    )
    part = table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("item_id"), "p_retailprice")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("store_id"), "n_regionkey"
    )
    region = table(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("state_id")
    )
    return (
        lines.join(part, "p_partkey").join(supplier, "s_suppkey").join(nation, "s_nationkey")
        .join(region, "n_regionkey")
    )


def sales_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per item, store and day; the sums are combined before the shuffle."""
    grouped = sold_lines(spark, sf_dir).groupBy("item_id", "store_id", "state_id", "run_date").agg(
        F.sum("l_quantity").cast("int").alias("sales")
    )
    brand = F.substring_index("item_id", "#", -1).cast("int")
    dept = F.floor((brand - 1) / 5) + 1
    return grouped.select(
        "item_id", "store_id", F.concat(F.lit("DEPT_"), dept.cast("string")).alias("dept_id"),
        F.concat(F.lit("CAT_"), (F.floor((dept - 1) / 2) + 1).cast("string")).alias("cat_id"), "state_id",
        F.concat(F.lit("d_"), (F.datediff("run_date", F.lit(BASE)) + 1).cast("string")).alias("d"), "sales",
        "run_date", F.lit(VERSION).alias("_pipeline_version"),
    )


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = table(spark, sf_dir, "lineitem").select(_day().alias("date")).distinct()
    day, month, year = F.dayofmonth("date"), F.month("date"), F.year("date")
    christmas = (month == 12) & (day == 25)
    independence = (month == 7) & (day == 4)
    valentine = (month == 2) & (day == 14)
    easter = valentine & (year % 2 == 0)
    named = {
        "event_name_1": F.when(christmas, "Christmas").when(independence, "IndependenceDay").when(
            valentine, "ValentinesDay"),
        "event_type_1": F.when(christmas | independence, "National").when(valentine, "Cultural"),
        "event_name_2": F.when(easter, "OrthodoxEaster"),
        "event_type_2": F.when(easter, "Religious"),
    }
    return days.select(
        F.concat(F.lit("d_"), (F.datediff("date", F.lit(BASE)) + 1).cast("string")).alias("d"), "date",
        week_of("date").alias("wm_yr_wk"), F.date_format("date", "EEEE").alias("weekday"),
        (F.dayofweek("date") % 7 + 1).alias("wday"), month.alias("month"), year.alias("year"),
        *[F.coalesce(value, F.lit("NaN")).alias(name) for name, value in named.items()],
        F.when(day <= 10, 1).otherwise(0).alias("snap_ca"),
        F.when(day != 31, F.when(day % 2 == 0, 1).otherwise(0)).alias("snap_tx"),
        F.when(day % 5 == 0, 1).otherwise(0).alias("snap_wi"),
    ).select(*CALENDAR_COLUMNS)


def sell_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The highest price per store, item and week; every tenth week has none."""
    weekly = sold_lines(spark, sf_dir).groupBy("store_id", "item_id", week_of("run_date").alias("wm_yr_wk")).agg(
        F.max("p_retailprice").alias("sell_price")
    )
    return weekly.where(F.col("wm_yr_wk") % 10 != 0).select(*PRICE_COLUMNS)


def first_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first day of the sales as a one-row side of the plan; reads one column of the lines."""
    return table(spark, sf_dir, "lineitem").agg(F.min(F.col("l_shipdate").cast("date")).alias("_first_day"))


# ---- raw files -----------------------------------------------------------------------------------------------


def write_wide_csv(spark: SparkSession, sf_dir: str, dirty: bool = False) -> str:
    """The wide sales file over all days; a day without sales is 0.

    A line is put together as text from a series' days in order, with the gaps filled in, and written as one cell
    under the whole header (the cell separator of the writer is a character no line holds). A series has at most
    one row per day. ``dirty`` replaces cells by malformed text by value, leaves gaps empty, and repeats every line
    with other numbers further down.
    """
    daily = sales_daily(spark, sf_dir).withColumn("n", F.substring_index("d", "_", -1).cast("int"))
    days = daily.agg(F.max("n")).first()[0]
    gap = "," if dirty else ",0"
    cell = dirty_cell(F.col("sales")) if dirty else F.col("sales").cast("string")
    last = F.lag("n", 1, 0).over(Window.partitionBy(*SALES_IDS).orderBy("n"))
    piece = F.concat(F.repeat(F.lit(gap), F.col("n") - last - 1), F.lit(","), cell)
    series = daily.select(*SALES_IDS, "n", piece.alias("piece")).groupBy(*SALES_IDS).agg(
        F.array_sort(F.collect_list(F.struct("n", "piece"))).alias("pieces"), F.max("n").alias("last")
    )
    start = F.concat_ws(",", *SALES_IDS)
    line = F.concat(
        start, F.array_join(F.transform("pieces", lambda p: p["piece"]), ""),
        F.repeat(F.lit(gap), F.lit(days) - F.col("last")),
    )
    lines = series.select(F.lit(0).alias("copy"), line.alias("line"))
    if dirty:
        lines = lines.unionByName(series.select(F.lit(1).alias("copy"), F.concat(start, F.repeat(F.lit(",77"), F.lit(days))).alias("line")))
        lines = lines.orderBy("copy", "line")
    header = ",".join([*SALES_IDS, *[f"d_{n}" for n in range(1, days + 1)]])
    path = scratch_path(spark, "sales-csv")
    lines.select(F.col("line").alias(header)).write.option("header", True).option("sep", "\u0001").csv(path)
    return path


def dirty_cell(sales: Column) -> Column:
    kind = F.coalesce(sales, F.lit(0)) % 5
    return (
        F.when(kind == 1, "abc").when(kind == 2, F.concat(sales.cast("string"), F.lit(".9"))).when(kind == 3, "NaN")
        .otherwise(F.coalesce(sales.cast("string"), F.lit("")))
    )


def dirty_prices(prices: DataFrame) -> DataFrame:
    """Prices as text; every tenth week's are unreadable."""
    text = F.when(F.col("wm_yr_wk") % 10 == 5, "n/a").otherwise(F.col("sell_price").cast("string"))
    return prices.withColumn("sell_price", text)


def shifted_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar ``SHIFT_YEARS`` later; 8 years are a whole leap cycle, so months and days stay as they are."""
    later = F.add_months("date", 12 * SHIFT_YEARS)
    return calendar(spark, sf_dir).withColumns({
        "date": later, "weekday": F.date_format(later, "EEEE"), "wday": F.dayofweek(later) % 7 + 1,
        "year": F.col("year") + SHIFT_YEARS,
    })


def write_raw_files(spark: SparkSession, sf_dir: str) -> tuple[str, str, str]:
    """Sales, calendar and price files; the calendar is the shifted one, as the gold rules refuse years before 2000."""
    calendar_path, prices_path = scratch_path(spark, "calendar-csv"), scratch_path(spark, "prices-csv")
    shifted_calendar(spark, sf_dir).write.option("header", True).csv(calendar_path)
    sell_prices(spark, sf_dir).write.option("header", True).csv(prices_path)
    return write_wide_csv(spark, sf_dir), calendar_path, prices_path


def dirty_text(flag: Column, status: Column, quantity: Column) -> Column:
    """Numbers, fractions and malformed text by return flag and line status."""
    whole = quantity.cast("int").cast("string")
    return (
        F.when(flag == "A", F.concat(whole, F.lit(".9")))
        .when((flag == "N") & (status == "O"), whole)
        .when(flag == "N", "NaN")
        .when(status == "F", "abc")
        .otherwise("")
    )


def dirty_date_text(status: Column, day: Column) -> Column:
    return (
        F.when(status == "F", day.cast("date").cast("string")).when(status == "O", "unknown").otherwise("1996-13-45")
    )


def dirty_silver(silver: DataFrame) -> DataFrame:
    """Silver rows that break every kind of rule, by value."""
    return silver.withColumns({
        "sales": F.when(F.col("wday") == 3, -F.col("sales")).otherwise(F.col("sales")),
        "wday": F.when(F.col("month") == 2, F.col("wday") + 7).otherwise(F.col("wday")),
        "dept_id": F.nullif("dept_id", F.lit("DEPT_3")),
        "snap_ca": F.col("snap_ca") + F.col("snap_wi"),
        "event_type_1": F.when(F.col("event_type_1") == "National", "Civic").otherwise(F.col("event_type_1")),
    })


# ---- stored tables -------------------------------------------------------------------------------------------

_STORED: dict[tuple[str, str, str], PipelineConfig] = {}


def pipeline(spark: SparkSession, base: dt.date = BASE) -> PipelineConfig:
    """Settings of a pipeline over these views with a fresh table root."""
    return PipelineConfig(
        root=scratch_path(spark, "tables"), base_date=base, version=VERSION, states=STATES, event_types=EVENT_TYPES,
    )


def stamp(spark: SparkSession, sf_dir: str) -> str:
    """Sizes and times of the given tables, so that stored ones are not taken for those of changed input."""
    path = spark._jvm.org.apache.hadoop.fs.Path(sf_dir)
    fs, told = path.getFileSystem(spark._jsc.hadoopConfiguration()), []
    for name in ("lineitem", "part", "supplier", "nation", "region"):
        file = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{name}.parquet")
        told.append(f"{fs.getContentSummary(file).getLength()}:{fs.getFileStatus(file).getModificationTime()}")
    return ",".join(told)


def _stored(spark: SparkSession, sf_dir: str, name: str, build) -> PipelineConfig:
    """A pipeline root holding one date-partitioned table, written once per session."""
    key = (spark.sparkContext.applicationId, f"{sf_dir} {stamp(spark, sf_dir)}", name)
    if key not in _STORED:
        cfg = pipeline(spark)
        overwrite_partitions(build(), cfg.table(name))
        _STORED[key] = cfg
    return _STORED[key]


def bronze_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    cfg = _stored(spark, sf_dir, "bronze_sales", lambda: sales_daily(spark, sf_dir))
    return read_table(spark, cfg.table("bronze_sales"), BRONZE_SCHEMA)


def gold_store(spark: SparkSession, sf_dir: str) -> PipelineConfig:
    def build() -> DataFrame:
        clock = F.lit(CLOCK.isoformat(sep=" ")).cast("timestamp")
        rows = silver(sales_daily(spark, sf_dir), calendar(spark, sf_dir), sell_prices(spark, sf_dir), clock, VERSION)
        return gold(rows, first_day(spark, sf_dir))

    return _stored(spark, sf_dir, "gold_table", build)


# ---- ledger --------------------------------------------------------------------------------------------------


def etl_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders read as runs: the priority is the job, the state is the order's."""
    status = F.when(F.col("o_orderstatus") == "F", "success").when(F.col("o_orderstatus") == "P", "failed")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("run_id"), F.col("o_orderpriority").alias("dag_id"),
        F.col("o_orderdate").cast("date").alias("run_date"), status.otherwise("running").alias("status"),
        F.col("o_orderdate").alias("created_at"),
    )


def etl_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines folded into the steps of their order; a returned open line fails its step."""
    step = F.when(F.col("l_linenumber") == 1, "bronze").when(F.col("l_linenumber") == 2, "silver").otherwise("gold")
    failed = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O")
    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("run_id"), step.alias("step_name")).agg(
        F.when(F.bool_or(failed), "failed").otherwise("success").alias("status"),
        F.count(F.lit(1)).alias("input_rows"), F.sum("l_quantity").cast("long").alias("output_rows"),
    )


def ledger_halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Known runs from the finished orders and rerun requests from all others, per job and date."""
    def half(chosen: Column, status: str, triggered_by: str, error: Column) -> DataFrame:
        return table(spark, sf_dir, "orders").where(chosen).groupBy(
            F.col("o_orderpriority").alias("dag_id"), F.col("o_orderdate").cast("date").alias("run_date")
        ).agg(
            F.min("o_orderkey").alias("run_id"), F.lit(status).alias("status"),
            F.lit(triggered_by).alias("triggered_by"), error.alias("error_message"),
            F.count(F.lit(1)).alias("rows_gold"),
        )

    finished = F.col("o_orderstatus") == "F"
    code = F.concat(F.lit("code "), F.count(F.lit(1)).cast("string"))
    return (
        half(finished, "success", "scheduler", code),
        half(~finished, "running", "manual", F.lit(None).cast("string")),
    )


def lineage_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Runs from orders, one dataset per order with lines, stages from its steps, a metric per stage."""
    runs = etl_runs(spark, sf_dir).withColumnRenamed("dag_id", "pipeline_name")
    name = F.concat(F.lit("ds_"), F.col("run_id").cast("string")).alias("dataset_id")
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("run_id"))
    datasets = lines.agg(F.count(F.lit(1)).alias("total_row_count")).select(
        "run_id", name, "total_row_count", F.lit("features").alias("feature_hash"), F.lit("schema").alias("schema_hash")
    )
    steps = etl_steps(spark, sf_dir)
    stages = steps.select("run_id", name, F.col("step_name").alias("stage"), "status")
    metrics = steps.select(
        "run_id", name, F.col("step_name").alias("stage"),
        (F.col("output_rows").cast("double") / F.col("input_rows")).alias("value"),
    )
    return runs, datasets, stages, metrics
