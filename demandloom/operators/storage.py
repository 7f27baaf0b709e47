"""Writes: write aside, check, publish by pointer.

A warehouse is a folder of tables. Every batch is written to a folder of its own, ``<table>/batch=<id>``, that nobody
reads until it is published; checks look at it there, and a refused batch is deleted. What is current is told by the
newest file in ``_snapshots``: per table the batch that holds each partition value (or the whole table). Publishing is the
creation of the next numbered file, which fails if it is there already. So any number of batches and tables become current
together, nothing is ever moved, and a reader that has resolved a snapshot goes on reading the same rows.

Writers need no lock. A writer that finds the next number taken looks at what the other one changed: anything it has
not built on is kept and the number after that is tried, else it is refused with ``StaleWrite``. Folders of batches that no
recent snapshot names are deleted by ``expire``. Paths go through Hadoop's file system; it must refuse a rename to
a name that exists (as HDFS does; on a local disk a hard link does the same).
"""

from __future__ import annotations

import datetime as dt
import json
import logging
import os
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager, suppress
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession

from demandloom.operators.quality import EmptyBatch, Rule, UniqueKey, check, enforce, observed, observed_report
from demandloom.schemas import DATE_COLUMN

logger = logging.getLogger(__name__)
Checks = Callable[[DataFrame], DataFrame]
MOVERS = 16
SNAPSHOTS = "_snapshots"
BATCH = "batch"
WHOLE = ""  # the only partition value of a table without partitions


class StaleWrite(RuntimeError):
    """Another writer has published a change to what this write is based on."""


# ---- files ---------------------------------------------------------------------------------------------------


def _fs(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _fs(spark, path)
    return fs.exists(target)


def delete(spark: SparkSession, path: str) -> None:
    fs, target = _fs(spark, path)
    fs.delete(target, True)


def rename(spark: SparkSession, source: str, target: str) -> None:
    fs, source_path = _fs(spark, source)
    _, target_path = _fs(spark, target)
    parent = target_path.getParent()
    if not fs.exists(parent):
        fs.mkdirs(parent)
    if not fs.rename(source_path, target_path):
        raise OSError(f"cannot move {source} to {target}")


def folder_names(spark: SparkSession, root: str) -> list[str]:
    """Names of the entries of a folder, fetched as one string: a call per entry would cost more than the listing."""
    fs, target = _fs(spark, root)
    if not fs.exists(target):
        return []
    paths = spark._jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(fs.listStatus(target))
    listed = spark._jvm.scala.runtime.ScalaRunTime.stringOf(paths).removeprefix("Array(").removesuffix(")")
    start = f"{fs.makeQualified(target).toString().rstrip('/')}/"  # a name holds no slash, so this only begins entries
    return [name.removesuffix(", ") for name in listed.split(start)[1:]]


def read_text(spark: SparkSession, path: str) -> str:
    fs, target = _fs(spark, path)
    stream = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _local(spark: SparkSession, path: str) -> str | None:
    """The path on this machine's disk, if that is where the file system keeps it."""
    fs, target = _fs(spark, path)
    return target.toUri().getPath() if fs.getUri().getScheme() == "file" else None


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Create a whole file under a name nobody has taken; false if it is taken. Readers see all of it or nothing."""
    folder, _, name = path.rpartition("/")
    token = f"{folder}/_new-{uuid.uuid4().hex}"
    local = _local(spark, folder)
    if local is not None:
        own = f"{local}/{token.rpartition('/')[2]}"
        os.makedirs(local, exist_ok=True)
        with open(own, "w", encoding="utf-8") as out:
            out.write(text)
            out.flush()
            os.fsync(out.fileno())
        try:
            os.link(own, f"{local}/{name}")
            return True
        except FileExistsError:
            return False
        finally:
            with suppress(OSError):
                os.unlink(own)
    return _renamed_once(spark, token, path, text)


def _renamed_once(spark: SparkSession, token: str, path: str, text: str) -> bool:
    """By a rename that refuses an existing target."""
    fs, source = _fs(spark, token)
    _, target = _fs(spark, path)
    fs.mkdirs(target.getParent())
    out = fs.create(source, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    files = spark._jvm.org.apache.hadoop.fs
    context = files.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    gateway = spark.sparkContext._gateway
    try:
        context.rename(fs.makeQualified(source), fs.makeQualified(target), gateway.new_array(getattr(files, "Options$Rename"), 0))
        return True
    except Py4JJavaError:
        # A lost answer looks like a failure: the file's text tells whose it is.
        if not fs.exists(target):
            raise
        return read_text(spark, path) == text
    finally:
        with suppress(Py4JJavaError):
            fs.delete(source, False)


# ---- snapshots -----------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class TableState:
    """Which batch holds each partition value of a table, and how many values each batch was written with."""

    partition: str | None = None
    places: Mapping[str, str] = field(default_factory=dict)
    written: Mapping[str, int] = field(default_factory=dict)

    def changed(self, partition: str | None, batch: str, values: Sequence[str], dropped: Sequence[str]) -> TableState:
        if self.places and self.partition != partition:
            raise ValueError(f"the table is partitioned by {self.partition}, the batch by {partition}")
        places = {value: at for value, at in self.places.items() if value not in set(dropped)}
        places.update(dict.fromkeys(values, batch))
        written = {at: count for at, count in self.written.items() if at in set(places.values())}
        return TableState(partition, places, {**written, **({batch: len(values)} if values else {})})

    def folders(self, root: str, values: Sequence[str] | None = None) -> list[str]:
        """Where the values lie; a batch that is wanted as a whole is one folder."""
        wanted: dict[str, list[str]] = {}
        for value in sorted(self.places) if values is None else sorted(set(values) & set(self.places)):
            wanted.setdefault(self.places[value], []).append(value)
        out = []
        for batch, held in wanted.items():
            folder = f"{root}/{BATCH}={batch}"
            whole = self.partition is None or len(held) == self.written[batch]
            out += [folder] if whole else [f"{folder}/{self.partition}={value}" for value in held]
        return out


@dataclass(frozen=True)
class Snapshot:
    """The tables of a warehouse at one time."""

    number: int = 0
    tables: Mapping[str, TableState] = field(default_factory=dict)

    def table(self, root: str) -> TableState | None:
        return self.tables.get(_split(root)[1])

    def to_json(self, writer: str) -> str:
        tables = {}
        for name, state in sorted(self.tables.items()):
            batches: dict[str, list[str]] = {}
            for value, batch in sorted(state.places.items()):
                batches.setdefault(batch, []).append(value)
            tables[name] = {"partition": state.partition, "batches": {b: {"values": v, "written": state.written[b]} for b, v in batches.items()}}
        return json.dumps({"number": self.number, "writer": writer, "tables": tables})

    @staticmethod
    def from_json(text: str) -> Snapshot:
        payload = json.loads(text)
        tables = {}
        for name, state in payload["tables"].items():
            places = {value: batch for batch, held in state["batches"].items() for value in held["values"]}
            tables[name] = TableState(state["partition"], places, {batch: held["written"] for batch, held in state["batches"].items()})
        return Snapshot(payload["number"], tables)


def _split(root: str) -> tuple[str, str]:
    warehouse, _, name = root.rstrip("/").rpartition("/")
    return warehouse, name


def _pointer(warehouse: str, number: int) -> str:
    return f"{warehouse}/{SNAPSHOTS}/{number:012d}.json"


def snapshot_numbers(spark: SparkSession, warehouse: str) -> list[int]:
    names = folder_names(spark, f"{warehouse}/{SNAPSHOTS}")
    return sorted(int(name.removesuffix(".json")) for name in names if name.endswith(".json") and name[0].isdigit())


def current(spark: SparkSession, warehouse: str) -> Snapshot:
    """The newest snapshot; an empty one where nothing was published yet."""
    while True:
        numbers = snapshot_numbers(spark, warehouse)
        if not numbers:
            return Snapshot()
        try:
            return Snapshot.from_json(read_text(spark, _pointer(warehouse, numbers[-1])))
        except Py4JJavaError:
            if exists(spark, _pointer(warehouse, numbers[-1])):
                raise  # there, but unreadable; one that expired meanwhile has a newer one


def snapshot_of(spark: SparkSession, root: str) -> Snapshot:
    """The newest snapshot of the warehouse that a table lies in."""
    return current(spark, _split(root)[0])


@dataclass(frozen=True)
class Change:
    """Partition values of a table that a batch now holds, and values that go."""

    name: str
    partition: str | None
    batch: str
    values: tuple[str, ...]
    dropped: tuple[str, ...] = ()


def commit(
    spark: SparkSession, warehouse: str, base: Snapshot, changes: Sequence[Change],
    relied: Mapping[str, Callable[[str], bool]] | None = None,
) -> Snapshot:
    """Make the changes current as one snapshot; refused if one of their values has changed since ``base``.

    ``relied`` tells, by table name, on which partition values they were built: those must not have changed either.
    """
    writer = uuid.uuid4().hex
    while True:
        now = current(spark, warehouse)
        tables = dict(now.tables)
        for name, wanted in (relied or {}).items():
            before, at = (snapshot.tables.get(name, TableState()).places for snapshot in (base, now))
            moved = [v for v in sorted({*before, *at}) if wanted(v) and before.get(v) != at.get(v)]
            if moved:
                raise StaleWrite(f"{name}, which this was built on, has changed since snapshot {base.number}: {', '.join(moved[:5])}")
        for change in changes:
            before, at = base.tables.get(change.name, TableState()), now.tables.get(change.name, TableState())
            moved = [v for v in (*change.values, *change.dropped) if before.places.get(v) != at.places.get(v)]
            if moved:
                raise StaleWrite(f"{change.name} has changed since snapshot {base.number}: {', '.join(moved[:5]) or 'all of it'}")
            tables[change.name] = tables.get(change.name, TableState()).changed(
                change.partition, change.batch, change.values, change.dropped)
        after = Snapshot(now.number + 1, tables)
        if create_once(spark, _pointer(warehouse, after.number), after.to_json(writer)):
            return after


def expire(spark: SparkSession, warehouse: str, keep: int) -> int:
    """Forget all but the newest ``keep`` snapshots and delete what only they name; returns how many went.

    Batches that no snapshot names yet belong to writers at work and are not touched.
    """
    numbers = snapshot_numbers(spark, warehouse)
    old, kept = numbers[: -max(1, keep)], numbers[-max(1, keep) :]
    if not old:
        return 0

    def named(chosen: Sequence[int]) -> set[tuple[str, str | None, str, str]]:
        out = set()
        for number in chosen:
            for name, state in Snapshot.from_json(read_text(spark, _pointer(warehouse, number))).tables.items():
                out |= {(name, state.partition, batch, value) for value, batch in state.places.items()}
        return out

    live = named(kept)
    alive = {(name, batch) for name, _, batch, _ in live}
    doomed = set()
    for name, partition, batch, value in named(old) - live:
        folder = f"{warehouse}/{name}/{BATCH}={batch}"
        doomed.add(f"{folder}/{partition}={value}" if (name, batch) in alive and partition else folder)
    with ThreadPoolExecutor(max_workers=MOVERS) as pool:
        list(pool.map(lambda path: delete(spark, path), sorted(doomed)))
        list(pool.map(lambda number: delete(spark, _pointer(warehouse, number)), old))
    return len(old)


# ---- reading -------------------------------------------------------------------------------------------------


def partition_values(spark: SparkSession, root: str, at: Snapshot | None = None) -> list[str]:
    """Current partition values of a table in order: no folder is listed, no file opened."""
    state = (at or snapshot_of(spark, root)).table(root)
    return sorted(state.places) if state else []


def partition_days(spark: SparkSession, root: str, at: Snapshot | None = None) -> list[dt.date]:
    return [dt.date.fromisoformat(value) for value in partition_values(spark, root, at)]


# ---- writing -------------------------------------------------------------------------------------------------


def cluster_for_write(df: DataFrame, column: str, sort: Sequence[str] = ()) -> DataFrame:
    """Bring the rows of a partition value together without letting one value fill one task.

    The rebalance hint lets AQE split a large value by size, so the number of files is the number of values plus
    the splits of large ones, not tasks times values. Sorting inside the files keeps row-group statistics selective.
    """
    return df.hint("rebalance", column).sortWithinPartitions(column, *sort)


@contextmanager
def scoped_settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """SQL settings for the jobs run inside, put back afterwards."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


PARALLEL_LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
LISTING_TASKS = 32  # at least; four waves over the cores of a larger cluster


def listed(spark: SparkSession, read: Callable[[], DataFrame]) -> DataFrame:
    """A Parquet read whose folders are listed by a few tasks per core.

    Spark lists many folders in a job of one task per folder: for a table of days most of that is the tasks' own cost.
    """
    tasks = min(int(spark.conf.get(PARALLEL_LISTING)), max(LISTING_TASKS, 4 * spark.sparkContext.defaultParallelism))
    with scoped_settings(spark, {PARALLEL_LISTING: str(tasks)}):
        return read()


# A task that holds many small partition values opens one file after the other. Keeping the shuffle partitions
# apart spreads those files over the cluster and changes neither their number nor the splitting of large values.
PARTITIONED_WRITE = {"spark.sql.adaptive.coalescePartitions.enabled": "false"}


class Swap:
    """Folder replacements that are kept together or undone together, for folders that are no tables.

    ``replace`` moves the old folder aside and the new one in. ``undo`` takes back every move made, newest first, goes
    on past moves that cannot be taken back and raises at the end with their list; ``finish`` deletes what was set aside.
    Nothing is deleted before ``finish``.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.moves: list[tuple[str, str]] = []  # every rename made, as (from, to)
        self.aside: list[str] = []

    def _move(self, source: str, target: str) -> None:
        rename(self.spark, source, target)
        self.moves.append((source, target))

    def replace(self, source: str, target: str) -> None:
        if exists(self.spark, target):
            parent, _, name = target.rstrip("/").rpartition("/")
            old = f"{parent}/_replaced-{uuid.uuid4().hex}-{name}"
            self._move(target, old)
            self.aside.append(old)
        self._move(source, target)

    def undo(self) -> None:
        stuck = []
        for source, target in reversed(self.moves):
            try:
                rename(self.spark, target, source)
            except Exception as error:  # noqa: BLE001
                stuck.append(f"{target} -> {source}: {error}")
        self.moves.clear()
        if stuck:
            raise OSError(f"could not take back {len(stuck)} moves: {'; '.join(stuck)}")

    def finish(self) -> None:
        for old in self.aside:
            delete(self.spark, old)


@dataclass(frozen=True)
class Batch:
    """A DataFrame meant for a table; with ``partition`` only the partitions it holds are replaced.

    ``rules`` are counted while the rows are written (a unique key afterwards, from the written key columns). ``checks``
    turns the written rows into a quality report. ``expected`` names partition values that must have rows, ``dropped`` values
    that go when the batch is published; ``allow_empty`` lets a whole table become empty.
    """

    df: DataFrame
    root: str
    partition: str | None = None
    checks: Checks | None = None
    sort: tuple[str, ...] = ()
    expected: tuple[str, ...] = ()
    allow_empty: bool = True
    rules: tuple[Rule | UniqueKey, ...] = ()
    layer: str = ""
    dropped: tuple[str, ...] = ()


def stage(batch: Batch, reports: list | None = None) -> tuple[str, tuple[str, ...]]:
    """Write the batch to a folder of its own and check it; returns its id and partition values.

    The rows of the reports are added to ``reports``.
    """
    reports = [] if reports is None else reports
    name, spark = f"b{uuid.uuid4().hex}", batch.df.sparkSession
    path = f"{batch.root}/{BATCH}={name}"
    ordered = batch.df
    if batch.partition:
        ordered = cluster_for_write(ordered, batch.partition, batch.sort)
    elif batch.sort:
        ordered = ordered.orderBy(*batch.sort)
    counts, seen = observed(batch.rules), Observation()
    if counts:  # above the shuffle: a task of the last stage counts once, however often it runs
        ordered = ordered.observe(seen, *counts)
    try:
        if batch.partition:
            with scoped_settings(spark, PARTITIONED_WRITE):
                ordered.write.partitionBy(batch.partition).parquet(path)
            prefix = f"{batch.partition}="
            values = tuple(sorted(entry[len(prefix) :] for entry in folder_names(spark, path) if entry.startswith(prefix)))
            missing = sorted(set(batch.expected) - set(values))
            if missing:
                raise EmptyBatch(f"no rows for {batch.root}: {', '.join(missing)}")
            empty = not values
        else:
            ordered.write.parquet(path)
            values = (WHOLE,)
            empty = not batch.allow_empty and spark.read.schema(batch.df.schema).parquet(path).isEmpty()
        if empty:
            raise EmptyBatch(f"no rows for {batch.root}")
        written = listed(spark, lambda: spark.read.schema(batch.df.schema).parquet(path))
        if batch.rules:
            keys = [rule for rule in batch.rules if isinstance(rule, UniqueKey)]
            report = observed_report(spark, batch.rules, batch.layer, seen.get if counts else {})
            reports += enforce(report.unionByName(check(written, keys, batch.layer)) if keys else report)
        if batch.checks is not None:
            reports += enforce(batch.checks(written))
        return name, values
    except BaseException:
        delete(spark, path)
        raise


def publish(
    batches: Sequence[Batch], base: Snapshot | None = None, dropped: Mapping[str, Sequence[str]] | None = None,
    relied: Mapping[str, Callable[[str], bool]] | None = None, reports: list | None = None,
) -> list[list[str]]:
    """Write and check every batch, then make all of them current at once; one failure publishes none.

    ``dropped`` names partition values of further tables (by path) that go in the same step. The batches are built on
    ``base`` (the newest snapshot if not given); ``relied`` tells, by path, which partition values of other tables they
    were computed from. Report rows are added to ``reports``. Returns the replaced partition values per batch (none for a whole table).
    """
    if not batches:
        return []
    spark = batches[0].df.sparkSession
    homes = {_split(root)[0] for root in (*[batch.root for batch in batches], *(dropped or {}), *(relied or {}))}
    if len(homes) != 1:
        raise ValueError(f"tables of one publish lie in one folder, not in {sorted(homes)}")
    warehouse = homes.pop()
    base = base or current(spark, warehouse)
    staged: list[tuple[Batch, str, tuple[str, ...]]] = []
    try:
        for batch in batches:
            staged.append((batch, *stage(batch, reports)))
        changes = [Change(_split(b.root)[1], b.partition, name, values, tuple(set(b.dropped) - set(values))) for b, name, values in staged]
        for root, values in (dropped or {}).items():
            state = base.table(root)
            gone = tuple(value for value in values if state and value in state.places)
            if gone:
                changes.append(Change(_split(root)[1], state.partition, "", (), gone))
        commit(spark, warehouse, base, changes, {_split(root)[1]: wanted for root, wanted in (relied or {}).items()})
    except BaseException:
        for batch, name, _ in staged:
            delete(spark, f"{batch.root}/{BATCH}={name}")
        raise
    return [list(values) if batch.partition else [] for batch, _, values in staged]


def overwrite_partitions(
    df: DataFrame,
    root: str,
    partition: str = DATE_COLUMN,
    checks: Checks | None = None,
    sort: Sequence[str] = ("item_id", "store_id"),
    expected: Sequence[dt.date] = (),
    rules: Sequence[Rule | UniqueKey] = (),
    layer: str = "",
) -> list[str]:
    """Replace exactly the partitions the batch holds; running the same batch again gives the same table.

    A failed critical rule, an empty batch or an expected day without rows raises and publishes nothing.
    """
    days = tuple(day.isoformat() for day in expected)
    return publish([Batch(df, root, partition, checks, tuple(sort), days, rules=tuple(rules), layer=layer)])[0]


def overwrite_table(
    df: DataFrame, root: str, checks: Checks | None = None, sort: Sequence[str] = (), base: Snapshot | None = None,
    rules: Sequence[Rule | UniqueKey] = (), layer: str = "",
) -> str:
    """Replace a whole table. The batch may read the table it replaces: readers of a snapshot keep its files."""
    publish([Batch(df, root, None, checks, tuple(sort), rules=tuple(rules), layer=layer)], base)
    return root


def days_from(spark: SparkSession, root: str, first: dt.date, at: Snapshot | None = None) -> list[str]:
    """Partition values of ``first`` and later days."""
    return [value for value in partition_values(spark, root, at) if value >= first.isoformat()]


def drop_partitions_from(spark: SparkSession, root: str, first: dt.date) -> None:
    """Take the partitions of ``first`` and later days out of the table."""
    warehouse, name = _split(root)
    base = current(spark, warehouse)
    gone = tuple(days_from(spark, root, first, base))
    if gone:
        commit(spark, warehouse, base, [Change(name, base.tables[name].partition, "", (), gone)])
