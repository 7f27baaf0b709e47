"""Run registered queries beside their SQL on DuckDB: ``python -m tests.compare <sf_dir> [query ...]``."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    return value


def spark_kinds(df) -> dict[str, str]:
    return {field.name: field.dataType.typeName() for field in df.schema}


KINDS = {
    "tinyint": "byte", "smallint": "short", "integer": "integer", "bigint": "long", "double": "double", "float": "float",
    "varchar": "string", "date": "date", "timestamp": "timestamp_ntz", "boolean": "boolean", "hugeint": "huge",
}


def compare(spark, connection, sf_dir: str, name: str, function, sql: str) -> list[str]:
    """Differences between both results; empty when they agree."""
    df = function(spark, sf_dir)
    ours_kinds = spark_kinds(df)
    columns = sorted(df.columns)
    ours = Counter(tuple(plain(row[c]) for c in columns) for row in df.select(*columns).collect())
    relation = connection.sql(sql)
    theirs_kinds = {c: str(t).lower() for c, t in zip(relation.columns, relation.types)}
    problems = []
    if sorted(theirs_kinds) != columns:
        return [f"columns {columns} vs {sorted(theirs_kinds)}"]
    for column in columns:
        expected = KINDS.get(theirs_kinds[column].split("(")[0], theirs_kinds[column])
        if expected != ours_kinds[column]:
            problems.append(f"type of {column}: {ours_kinds[column]} vs {theirs_kinds[column]}")
    order = [relation.columns.index(c) for c in columns]
    theirs = Counter(tuple(plain(row[i]) for i in order) for row in relation.fetchall())
    if sum(ours.values()) != sum(theirs.values()):
        problems.append(f"rows {sum(ours.values())} vs {sum(theirs.values())}")
    if ours != theirs:
        extra, missing = list((ours - theirs).elements()), list((theirs - ours).elements())
        problems.append(f"values: {len(extra)} only here, {len(missing)} only in SQL\n  {columns}\n  {extra[:2]}\n  {missing[:2]}")
    if not ours:
        problems.append("no rows")
    return problems


def main(sf_dir: str, *names: str) -> int:
    import __spark_entry__ as entry
    from demandloom.session import build_session

    spark = build_session(
        master="local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g",
           "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("OFF")
    queries, oracles = entry.queries(), entry.oracle_sql()
    connection, bad = connect(sf_dir), 0
    for name in names or queries:
        started = time.time()
        try:
            if name in oracles:
                problems = compare(spark, connection, sf_dir, name, queries[name], oracles[name])
            else:
                problems = [] if queries[name](spark, sf_dir).collect() else ["no rows"]
        except Exception as error:  # noqa: BLE001
            problems = [f"{type(error).__name__}: {str(error)[:600]}"]
        bad += bool(problems)
        print(f"{'FAIL' if problems else 'ok'} {name} {time.time() - started:.1f}s", *problems, flush=True)
    print(f"{bad} differ")
    return bad


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
