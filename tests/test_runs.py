"""Whole runs over small CSV files."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from demandloom.config import PipelineConfig
from demandloom.operators.quality import EmptyBatch, QualityError
from demandloom.operators import storage
from demandloom.operators.storage import StaleWrite, partition_days
from demandloom.plans import bronze, gold, runs, silver
from demandloom.schemas import GOLD_SCHEMA, PREDICTION_COLUMNS, SERIES_KEY
from demandloom.sources.tables import read_table

BASE = dt.date(2011, 1, 29)
DAYS = 60


def day(n):
    return BASE + dt.timedelta(days=n)


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    rng = random.Random(4)
    labels = ",".join(f"d_{n + 1}" for n in range(DAYS))
    sales = [f"item_id,dept_id,cat_id,store_id,state_id,{labels}"]
    for item in range(4):
        for store, state in (("CA_1", "CA"), ("TX_1", "TX")):
            cells = ",".join(str(rng.randint(0, 9) + item) for _ in range(DAYS))
            sales.append(f"I{item},D{item % 2},C,{store},{state},{cells}")
    calendar = ["d,date,wm_yr_wk,weekday,wday,month,year,event_name_1,event_type_1,event_name_2,event_type_2,snap_CA,snap_TX,snap_WI"]
    for n in range(DAYS - 1):
        when = day(n)
        event = "SuperBowl,Sporting" if n == 8 else "NaN,NaN"
        calendar.append(f"d_{n + 1},{when},{11101 + n // 7},{when:%A},{(when.weekday() + 2) % 7 + 1},{when.month},{when.year},{event},NaN,NaN,{n % 2},,1")
    prices = ["store_id,item_id,wm_yr_wk,sell_price"]
    for week in range(DAYS // 7 + 1):
        prices += [f"{store},I{item},{11101 + week},{item + 1}.25" for item in range(4) for store in ("CA_1", "TX_1") if (item, week) != (0, 0)]
    paths = []
    for name, lines in (("sales", sales), ("calendar", calendar), ("prices", prices)):
        path = folder / f"{name}.csv"
        path.write_text("\n".join(lines) + "\n")
        paths.append(str(path))
    return paths


def config(tmp_path, **changes):
    return PipelineConfig(root=str(tmp_path / "tables"), clock=dt.datetime(2030, 1, 1), **changes)


def gold_rows(spark, cfg):
    return sorted(map(str, read_table(spark, cfg.table(gold.GOLD), GOLD_SCHEMA).collect()))


def test_daily_runs_with_tails_equal_one_backfill(spark, tmp_path, files):
    last = 34
    whole, daily = config(tmp_path / "a"), config(tmp_path / "b")
    every = [day(n) for n in range(last + 1)]
    bronze.run_bronze(spark, whole, every, *files)
    silver.run_silver(spark, whole, every)
    gold.run_gold(spark, whole, every, keep_tail=False)
    bronze.run_bronze(spark, daily, every, *files)
    silver.run_silver(spark, daily, every[:-2])
    gold.run_gold(spark, daily, every[:-2])
    for n in (last - 1, last):
        silver.run_silver(spark, daily, [day(n)])
        gold.run_gold(spark, daily, [day(n)])
    assert gold_rows(spark, daily) == gold_rows(spark, whole)
    tails = partition_days(spark, daily.table(gold.TAIL))
    assert tails == [day(last - 1), day(last)]
    gold.run_gold(spark, daily, [day(last)])
    assert gold_rows(spark, daily) == gold_rows(spark, whole)
    silver.run_silver(spark, daily, [day(last - 1)])
    assert partition_days(spark, daily.table(gold.TAIL)) == []
    gold.run_gold(spark, daily, [day(last)], keep_tail=False)
    assert gold_rows(spark, daily) == gold_rows(spark, whole)


def test_an_older_rerun_says_that_it_reads_everything(spark, tmp_path, files, caplog):
    cfg = config(tmp_path, tails_kept=1)
    days = [day(n) for n in range(4)]
    bronze.run_bronze(spark, cfg, days, *files)
    silver.run_silver(spark, cfg, days)
    for d in days:
        gold.run_gold(spark, cfg, [d])
    assert partition_days(spark, cfg.table(gold.TAIL)) == days[-1:] and not caplog.records
    gold.run_gold(spark, cfg, days[1:2], keep_tail=False)
    assert "no tail before" in caplog.text


def test_gold_built_on_silver_that_changes_meanwhile_is_refused(spark, tmp_path, files, monkeypatch):
    cfg = config(tmp_path)
    days = [day(0), day(1)]
    bronze.run_bronze(spark, cfg, days, *files)
    silver.run_silver(spark, cfg, days)
    real = gold.publish

    def publish(*args, **kw):
        monkeypatch.setattr(gold, "publish", real)
        silver.run_silver(spark, cfg, [day(0)])
        return real(*args, **kw)

    monkeypatch.setattr(gold, "publish", publish)
    with pytest.raises(StaleWrite):
        gold.run_gold(spark, cfg, [day(1)])
    assert partition_days(spark, cfg.table(gold.GOLD)) == [] == partition_days(spark, cfg.table(gold.TAIL))
    gold.run_gold(spark, cfg, [day(1)])
    assert partition_days(spark, cfg.table(gold.GOLD)) == [day(1)]


def test_refused_runs(spark, tmp_path, files):
    cfg = config(tmp_path)
    bronze.run_bronze(spark, cfg, [day(0), day(DAYS - 1)], *files)
    with pytest.raises(EmptyBatch):
        silver.run_silver(spark, cfg, [day(DAYS - 1)])
    silver.run_silver(spark, cfg, [day(0)])
    with pytest.raises(EmptyBatch):
        gold.run_gold(spark, cfg, [day(1)])
    strict = config(tmp_path, states=("CA",))
    with pytest.raises(QualityError, match="state_id"):
        gold.run_gold(spark, strict, [day(0)])
    assert partition_days(spark, cfg.table(gold.GOLD)) == []


def test_ledger_of_good_and_bad_runs(spark, tmp_path, files):
    cfg = config(tmp_path)
    first = runs.run_etl(spark, cfg, [day(0)], *files)
    with pytest.raises(EmptyBatch):
        runs.run_etl(spark, cfg, [day(DAYS - 1)], files[0])
    again = runs.run_etl(spark, cfg, [day(0)], files[0])
    book = runs.Ledger(spark, cfg)
    found = {r["run_date"]: r for r in book.etl_runs().collect()}
    good, bad = found[day(0)], found[day(DAYS - 1)]
    assert first == again == good["run_id"] and bad["run_id"] != good["run_id"]
    assert (good["status"], good["rows_bronze"], good["rows_silver"], good["rows_gold"]) == ("success", 8, 8, 8)
    assert bad["status"] == "failed" and "silver=failed" in bad["error_message"] and bad["rows_bronze"] == 8
    steps = {(r["run_id"], r["step_name"]): r for r in book.etl_steps().collect()}
    assert len(steps) == 5 and steps[bad["run_id"], "silver"]["input_rows"] == 8
    assert steps[good["run_id"], "gold"]["status"] == "success"
    assert book.latest_etl_run(day(0)) == first
    with pytest.raises(ValueError):
        book.latest_etl_run(day(3))


def test_learning_run(spark, tmp_path, files):
    cfg = config(tmp_path, model_rounds=2)
    days = [day(n) for n in range(45)]
    runs.run_etl(spark, cfg, days, *files)
    result = runs.run_ml(spark, cfg, days[-1])
    manifest, metrics = result["manifest"], result["metrics"]
    assert manifest["row_counts"]["total"] == 45 * 8 == sum(manifest["row_counts"][s] for s in ("train", "val", "test"))
    scored = spark.read.parquet(f"{manifest['dataset_dir']}/predictions")
    assert scored.columns == PREDICTION_COLUMNS and scored.count() == manifest["row_counts"]["test"]
    by_hand = scored.agg((F.sum(F.abs(F.col("sales") - F.col("prediction"))) / (F.sum("sales") + 1e-8)).alias("w")).first()["w"]
    assert metrics["test_wmape"] == pytest.approx(by_hand) and metrics["store_id_worst_wmape"] >= metrics["store_id_best_wmape"]
    assert {r["store_id"] for r in scored.select("store_id").distinct().collect()} == {"CA_1", "TX_1"}
    book = runs.Ledger(spark, cfg)
    view = {r["stage"]: r["stage_status"] for r in book.lineage().collect()}
    assert view == {"train": "success", "predict": "success", "evaluate": "success"}
    stages = {r["stage"]: r for r in book.ml_stages().collect()}
    assert stages["train"]["source_tracking_id"] is None and stages["predict"]["source_tracking_id"] == stages["train"]["tracking_id"]
    assert stages["evaluate"]["source_tracking_id"] == stages["predict"]["tracking_id"]
    stored = {(r["stage"], r["metric"], r["slice"]): r["value"] for r in book.lineage(metrics=True).collect()}
    assert stored["predict", "prediction_rows", "all"] == scored.count() == stored["evaluate", "rows", "all"]
    assert stored["evaluate", "test_wmape", "all"] == metrics["test_wmape"]
    assert {s for _, _, s in stored if s.startswith("model=")} == {"model=baseline_prediction", "model=gbt_depth6", "model=gbt_depth8"}
    one = scored.where("store_id = 'CA_1'").agg(F.avg(F.abs(F.col("sales") - F.col("prediction")))).first()[0]
    assert stored["evaluate", "mae", "store_id=CA_1"] == pytest.approx(one)
    assert scored.select(*SERIES_KEY, "run_date").distinct().count() == scored.count()
    rebuilt = runs.run_ml(spark, cfg, days[-1])["manifest"]
    assert rebuilt["content_hash"] == manifest["content_hash"]
    assert book.lineage(metrics=True).count() == len(stored)
    assert rebuilt["dataset_id"] == manifest["dataset_id"] and book.datasets().count() == 1
    book.delete_ml_run(manifest["run_id"])
    left = [book.ml_runs(), book.datasets(), book.ml_stages(), book.metrics()]
    assert [t.count() for t in left] == [0, 0, 0, 0] and book.etl_runs().count() == 1


def ledger_state(book):
    return [sorted(map(str, t.collect())) for t in (book.etl_runs(), book.etl_steps(), book.ml_runs(), book.ml_stages())]


def filled_ledger(spark, cfg):
    book = runs.Ledger(spark, cfg)
    for n in range(2):
        run_id = book.start_etl_run(day(n))
        book.start_step(run_id, "bronze")
        book.finish_step(run_id, "bronze", "success", (0, 5))
    book.start_ml_run("1", day(0))
    return book


@pytest.mark.parametrize("failing", [1, 2, "pointer"])
def test_a_failed_delete_changes_no_table(spark, tmp_path, monkeypatch, failing):
    book = filled_ledger(spark, config(tmp_path))
    before, real, calls = ledger_state(book), storage.stage, []

    def stage(batch, reports=None):
        calls.append(batch)
        if len(calls) == failing:
            raise OSError("no connection")
        return real(batch, reports)

    def no_pointer(*_):
        raise OSError("no connection")

    monkeypatch.setattr(storage, "stage", stage)
    if failing == "pointer":
        monkeypatch.setattr(storage, "create_once", no_pointer)
    for delete in (lambda: book.delete_etl_run(1), lambda: book.delete_ml_run("1")):
        calls.clear()
        with pytest.raises(OSError):
            delete()
    monkeypatch.undo()
    assert ledger_state(book) == before
    book.delete_etl_run(1)
    assert [r["run_id"] for r in book.etl_runs().collect()] == [2] == [r["run_id"] for r in book.etl_steps().collect()]


def test_steps_and_stages_need_their_run(spark, tmp_path):
    book = filled_ledger(spark, config(tmp_path))
    before = ledger_state(book)
    with pytest.raises(QualityError, match="references"):
        book.start_step(9, "bronze")
    with pytest.raises(QualityError, match="references"):
        book.start_stage("9", "d", "train", "t")
    with pytest.raises(QualityError, match="references"):
        book.log_metrics("1", "d", "train", spark.createDataFrame([("m", "all", 1.0)], "metric string, slice string, value double"))
    assert ledger_state(book) == before


def test_two_ledger_writers_lose_nothing(spark, tmp_path):
    """Eight threads start runs of different days at once: every run is there, with an id of its own."""
    from concurrent.futures import ThreadPoolExecutor

    cfg = config(tmp_path)
    with ThreadPoolExecutor(max_workers=8) as pool:
        ids = list(pool.map(lambda n: runs.Ledger(spark, cfg).start_etl_run(day(n)), range(8)))
    assert sorted(ids) == list(range(1, 9)) == sorted(r["run_id"] for r in runs.Ledger(spark, cfg).etl_runs().collect())
    book = runs.Ledger(spark, cfg)
    at = book.snapshot()
    table = book.etl_runs(at)
    book.write({"etl_pipeline_runs": table.where("run_id < 8")}, at)
    with pytest.raises(StaleWrite):
        book.write({"etl_pipeline_runs": table.where("run_id > 1")}, at)
    assert sorted(r["run_id"] for r in book.etl_runs().collect()) == list(range(1, 8))
