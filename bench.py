"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Each query is run once to warm up and then ``$BENCH_RUNS`` times into the no-op sink; the median counts. Queries on
raw tables include the derivation of the retail views; ``gold_day_*`` run on date-partitioned tables written before.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import DataFrame

from demandloom import fixtures as X
from demandloom import schemas as S
from demandloom.operators.storage import overwrite_partitions
from demandloom.plans import gold as gold_plan
from demandloom.registry import spark_queries as Q
from demandloom.session import build_session
from demandloom.sources.tables import read_days

HEADLINE = [
    "silver_partition", "gold_backfill", "gold_partition", "slice_metrics", "overall_metrics", "vocabulary",
    "ordinal_encode", "dedup_keep_first", "quality_report", "upsert_update", "lineage_view",
]


def consume(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("OFF")
    work = {"sales_daily": lambda: consume(X.sales_daily(spark, sf_dir))}
    for name in HEADLINE:
        work[name] = lambda name=name: consume(Q.QUERIES[name](spark, sf_dir))

    cfg = X.pipeline(spark)
    overwrite_partitions(Q.silver_rows(spark, sf_dir), cfg.table(gold_plan.SILVER))
    days = gold_plan.partition_days(spark, cfg.table(gold_plan.SILVER))
    day, before = days[-1], days[-2]

    def gold_day() -> None:
        history = gold_plan.narrow_history(spark, cfg, [day], days)
        today = read_days(spark, cfg.table(gold_plan.SILVER), S.SILVER_SCHEMA, [day])
        consume(gold_plan.gold_for(history, today, [day], days[0]))

    def tail() -> None:
        rows = read_days(spark, cfg.table(gold_plan.SILVER), S.SILVER_SCHEMA, days[:-1])
        gold_plan.write_tail(rows.select(*gold_plan.HISTORY_COLUMNS), spark, cfg, before)

    def measure(action) -> float:
        action()
        times = []
        for _ in range(runs):
            started = time.perf_counter()
            action()
            times.append(time.perf_counter() - started)
        return round(statistics.median(times), 3)

    seconds = {name: measure(action) for name, action in work.items()}
    seconds["gold_day_full_history"] = measure(gold_day)
    tail()
    seconds["gold_day_from_tail"] = measure(gold_day)
    print(json.dumps({
        "metric": "sum of median query times", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
