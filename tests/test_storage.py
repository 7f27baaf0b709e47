from __future__ import annotations

import datetime as dt
import os
import threading

import pytest
from pyspark.sql import functions as F

from demandloom.operators import storage
from demandloom.operators.quality import EmptyBatch, QualityError, UniqueKey, at_least, check
from demandloom.session import scratch_path, shared_folder
from demandloom.sources.tables import read_days, read_table

DAYS = [dt.date(2020, 1, n) for n in range(1, 5)]
SCHEMA = "item_id string, store_id string, sales int, run_date date"


def frame(spark, days, sales=1):
    return spark.createDataFrame([(f"i{n}", "s", sales + n, day) for day in days for n in range(3)], SCHEMA)


def rows(spark, root, at=None):
    table = read_table(spark, root, spark.createDataFrame([], SCHEMA).schema, at)
    return sorted(tuple(r) for r in table.select("item_id", "store_id", "sales", "run_date").collect())


def gate(df):
    return check(df, [at_least("sales", 0)], "t")


def batches(root):
    return sorted(name for name in os.listdir(root) if not name.startswith("."))


def pointers(root):
    return sorted(os.listdir(f"{os.path.dirname(root)}/_snapshots"))


def test_overwriting_twice_changes_nothing_and_other_days_stay(spark, tmp_path):
    root = str(tmp_path / "t")
    storage.overwrite_partitions(frame(spark, DAYS), root)
    once = rows(spark, root)
    assert storage.overwrite_partitions(frame(spark, DAYS[:2]), root) == ["2020-01-01", "2020-01-02"]
    assert rows(spark, root) == once
    storage.overwrite_partitions(frame(spark, DAYS[1:2], sales=50), root)
    changed = rows(spark, root)
    assert [r for r in changed if r[3] != DAYS[1]] == [r for r in once if r[3] != DAYS[1]]
    assert {r[2] for r in changed if r[3] == DAYS[1]} == {50, 51, 52}
    assert storage.partition_days(spark, root) == DAYS and len(batches(root)) == len(pointers(root)) == 3


@pytest.mark.parametrize("kind", ["bad", "empty", "missing day"])
def test_a_refused_batch_leaves_the_table_alone(spark, tmp_path, kind):
    root = str(tmp_path / "t")
    storage.overwrite_partitions(frame(spark, DAYS[:2]), root, checks=gate)
    before, there = rows(spark, root), (batches(root), pointers(root))
    batch = {"bad": frame(spark, DAYS[:1], -10), "empty": frame(spark, DAYS).where("false"), "missing day": frame(spark, DAYS[:2])}
    with pytest.raises(QualityError if kind == "bad" else EmptyBatch):
        storage.overwrite_partitions(batch[kind], root, checks=gate, expected=DAYS[:3] if kind == "missing day" else ())
    assert rows(spark, root) == before and (batches(root), pointers(root)) == there


def test_one_refused_batch_stops_all(spark, tmp_path):
    facts, dim = str(tmp_path / "facts"), str(tmp_path / "dim")
    storage.publish([storage.Batch(frame(spark, DAYS[:1]), facts, "run_date"), storage.Batch(frame(spark, DAYS[:1]), dim)])
    before, there = rows(spark, facts), (batches(facts), batches(dim), pointers(dim))
    with pytest.raises(QualityError):
        storage.publish([
            storage.Batch(frame(spark, DAYS[:1], 40), facts, "run_date"),
            storage.Batch(frame(spark, DAYS[:1], -9), dim, checks=gate),
        ])
    assert rows(spark, facts) == before == rows(spark, dim)
    assert (batches(facts), batches(dim), pointers(dim)) == there


def test_a_table_may_replace_itself(spark, tmp_path):
    root = str(tmp_path / "t")
    storage.overwrite_table(frame(spark, DAYS), root)
    storage.overwrite_table(read_table(spark, root).withColumn("sales", F.col("sales") * 2), root, sort=("item_id",))
    assert {r[2] for r in rows(spark, root)} == {2, 4, 6}


def test_a_hot_day_is_written_by_many_tasks(spark, tmp_path):
    """One day holds nearly all rows; its files follow its size, other days get one file each."""
    root = str(tmp_path / "t")
    hot = spark.range(300000).select(
        F.sha2(F.col("id").cast("string"), 256).alias("item_id"), F.lit("s").alias("store_id"),
        F.col("id").cast("int").alias("sales"), F.lit(DAYS[0]).alias("run_date"),
    ).repartition(8)
    with storage.scoped_settings(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "2MB"}):
        storage.overwrite_partitions(hot.unionByName(frame(spark, DAYS[1:])), root)
    (batch,) = batches(root)
    files = {day: len([f for f in os.listdir(f"{root}/{batch}/run_date={day}") if f.endswith(".parquet")]) for day in DAYS}
    assert files[DAYS[0]] > 4 and set(list(files.values())[1:]) == {1}
    assert read_table(spark, root).count() == 300009


def test_settings_are_put_back(spark):
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    with pytest.raises(RuntimeError), storage.scoped_settings(spark, {key: "false"}):
        assert spark.conf.get(key) == "false"
        raise RuntimeError
    assert spark.conf.get(key) == before


def test_dropping_days_from_a_date_on(spark, tmp_path):
    root = str(tmp_path / "t")
    storage.overwrite_partitions(frame(spark, DAYS), root)
    storage.drop_partitions_from(spark, root, DAYS[2])
    assert storage.partition_days(spark, root) == DAYS[:2]


def test_scratch_paths_lie_in_the_shared_folder_and_differ(spark):
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first != second and first.startswith(shared_folder(spark))


def pair(spark, facts, dim, sales):
    return [storage.Batch(frame(spark, DAYS[:3], sales), facts, "run_date"), storage.Batch(frame(spark, DAYS[:2], sales), dim)]


@pytest.mark.parametrize("failing", ["first batch", "second batch", "pointer"])
def test_a_failure_leaves_every_table_as_it_was(spark, tmp_path, monkeypatch, failing):
    facts, dim = str(tmp_path / "facts"), str(tmp_path / "dim")
    storage.publish(pair(spark, facts, dim, 1))
    before, there = (rows(spark, facts), rows(spark, dim)), (batches(facts), batches(dim), pointers(dim))
    real, calls = storage.stage, []

    def stage(batch, reports=None):
        calls.append(batch)
        if len(calls) == {"first batch": 1, "second batch": 2}.get(failing):
            raise OSError("no connection")
        return real(batch, reports)

    def no_pointer(*_):
        raise OSError("no connection")

    monkeypatch.setattr(storage, "stage", stage)
    if failing == "pointer":
        monkeypatch.setattr(storage, "create_once", no_pointer)
    with pytest.raises(OSError):
        storage.publish(pair(spark, facts, dim, 40))
    assert (rows(spark, facts), rows(spark, dim)) == before and (batches(facts), batches(dim), pointers(dim)) == there
    monkeypatch.undo()
    storage.publish(pair(spark, facts, dim, 40))
    assert len(rows(spark, facts)) == 9 and {r[2] for r in rows(spark, dim)} == {40, 41, 42}


def test_a_reader_never_misses_a_day_while_others_publish(spark, tmp_path):
    """Fifty publishes of two tables, old states deleted on the way; each reader's snapshot holds one state of both."""
    facts, dim = str(tmp_path / "facts"), str(tmp_path / "dim")
    storage.publish(pair(spark, facts, dim, 0))
    seen, problems, over = [], [], threading.Event()

    def read():
        while not over.is_set():
            at = storage.current(spark, str(tmp_path))
            found, known = rows(spark, facts, at), rows(spark, dim, at)
            states = {r[2] - int(r[0][1:]) for r in found} | {r[2] - int(r[0][1:]) for r in known}
            if {r[3] for r in found} != set(DAYS[:3]) or len(states) != 1:
                problems.append((at.number, states))
            seen.append(at.number)

    reader = threading.Thread(target=read)
    reader.start()
    try:
        for turn in range(1, 51):
            storage.publish(pair(spark, facts, dim, turn * 10))
            storage.expire(spark, str(tmp_path), 20)
    finally:
        over.set()
        reader.join()
    assert not problems and len(set(seen)) > 5
    assert len(pointers(facts)) == 20 and len(batches(facts)) == 20 == len(batches(dim))
    assert {r[2] for r in rows(spark, dim)} == {500, 501, 502}


def test_no_folder_is_moved_by_a_publish(spark, tmp_path, monkeypatch):
    def refused(*_):
        raise AssertionError("moved")

    monkeypatch.setattr(storage, "rename", refused)
    storage.overwrite_partitions(frame(spark, DAYS), str(tmp_path / "t"))
    storage.overwrite_partitions(frame(spark, DAYS, 5), str(tmp_path / "t"))
    assert len(rows(spark, str(tmp_path / "t"))) == 12


def test_of_two_writers_of_one_value_one_is_refused(spark, tmp_path):
    """Both start from the same state; nothing of the first is lost, and other tables and days do not stand in the way."""
    root, other = str(tmp_path / "t"), str(tmp_path / "u")
    storage.overwrite_table(frame(spark, DAYS[:1]), root)
    storage.overwrite_partitions(frame(spark, DAYS[:2]), other)
    base = storage.current(spark, str(tmp_path))
    outcome, start = [], threading.Barrier(2)

    def write(sales):
        start.wait()
        try:
            storage.publish([storage.Batch(frame(spark, DAYS[:1], sales), root)], base)
            outcome.append(sales)
        except storage.StaleWrite:
            outcome.append(None)

    threads = [threading.Thread(target=write, args=(sales,)) for sales in (100, 200)]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    (won,) = [sales for sales in outcome if sales]
    assert {r[2] for r in rows(spark, root)} == {won, won + 1, won + 2} and len(batches(root)) == 2
    storage.publish([storage.Batch(frame(spark, DAYS[1:3], 7), other, "run_date")], base)
    with pytest.raises(storage.StaleWrite):
        storage.publish([storage.Batch(frame(spark, DAYS[2:3], 8), other, "run_date")], base)
    with pytest.raises(storage.StaleWrite):
        storage.publish([storage.Batch(frame(spark, DAYS[3:], 9), other, "run_date")], base, relied={root: lambda value: True})
    storage.publish([storage.Batch(frame(spark, DAYS[3:], 9), other, "run_date")], base, relied={other: lambda value: value < "2020-01-02"})
    assert storage.partition_days(spark, other) == DAYS


def test_a_taken_pointer_is_not_written_again(spark, tmp_path):
    path = str(tmp_path / "_snapshots/000000000001.json")
    for create in (storage.create_once, lambda s, p, text: storage._renamed_once(s, p + ".new", p, text)):
        first, second = create(spark, path, "one"), create(spark, path, "two")
        assert (first, second) in ((True, False), (False, False)) and storage.read_text(spark, path) == "one"
    other = str(tmp_path / "_snapshots/000000000002.json")
    assert storage._renamed_once(spark, other + ".new", other, "größe") and storage.read_text(spark, other) == "größe"
    assert sorted(n for n in os.listdir(tmp_path / "_snapshots") if not n.startswith(".")) == ["000000000001.json", "000000000002.json"]


def test_an_old_snapshot_reads_its_own_rows_until_it_expires(spark, tmp_path):
    root = str(tmp_path / "t")
    storage.overwrite_partitions(frame(spark, DAYS[:2]), root)
    first = storage.current(spark, str(tmp_path))
    storage.overwrite_partitions(frame(spark, DAYS[1:3], 50), root)
    storage.drop_partitions_from(spark, root, DAYS[2])
    assert len(rows(spark, root, first)) == 6 and {r[2] for r in rows(spark, root, first)} == {1, 2, 3}
    schema = spark.createDataFrame([], SCHEMA).schema
    assert read_days(spark, root, schema, DAYS[1:], first).count() == 3 and read_days(spark, root, schema, DAYS[2:]).count() == 0
    assert storage.expire(spark, str(tmp_path), 1) == 2 and len(pointers(root)) == 1
    assert sorted(os.listdir(f"{root}/{batches(root)[0]}") + os.listdir(f"{root}/{batches(root)[1]}")).count("run_date=2020-01-02") == 1
    assert [r[2] for r in rows(spark, root) if r[3] == DAYS[1]] == [50, 51, 52] and len(rows(spark, root)) == 6


def test_rules_are_counted_by_the_write_itself(spark, tmp_path):
    """One job reads the source; the key check reads the written rows."""
    root, reads = str(tmp_path / "t"), spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    source = frame(spark, DAYS).coalesce(1).mapInArrow(seen, SCHEMA)
    reports = []
    batch = storage.Batch(source, root, "run_date", rules=(at_least("sales", 2), UniqueKey(("item_id", "run_date"))), layer="t")
    with pytest.raises(QualityError) as refused:
        storage.publish([batch], reports=reports)
    assert reads.value == 12 and reports == [] and not batches(root)
    assert [(r["rule"], r["failed_rows"], r["total_rows"], r["passed"]) for r in refused.value.report] == [
        ("at_least(sales,2)", 4, 12, False), ("unique(item_id,run_date)", 0, 12, True)]
    storage.publish([storage.Batch(frame(spark, DAYS), root, "run_date", rules=(at_least("sales", 1),), layer="t")], reports=reports)
    assert [r["passed"] for r in reports] == [True]
    doubled = frame(spark, DAYS[:1]).unionByName(frame(spark, DAYS[:1]))
    with pytest.raises(QualityError, match="unique"):
        storage.overwrite_partitions(doubled, root, rules=[UniqueKey(("item_id", "run_date"))], layer="t")


def test_moves_that_cannot_be_taken_back_do_not_stop_the_others(spark, monkeypatch):
    swap, made = storage.Swap(spark), []
    swap.moves = [("a", "b"), ("c", "d"), ("e", "f")]

    def rename(_, source, target):
        made.append((source, target))
        if source == "d":
            raise OSError("gone")

    monkeypatch.setattr(storage, "rename", rename)
    with pytest.raises(OSError, match="1 moves: d -> c"):
        swap.undo()
    assert made == [("f", "e"), ("d", "c"), ("b", "a")] and swap.moves == []


def test_names_with_commas_and_blanks_are_listed(spark, tmp_path):
    (tmp_path / "a, b").mkdir()
    (tmp_path / "a, b" / "c, d=1").mkdir()
    assert storage.folder_names(spark, str(tmp_path / "a, b")) == ["c, d=1"]
