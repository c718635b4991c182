"""Compare registered queries with their SQL: ``python tests/oracle_check.py [sf_dir] [name ...]``."""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import tempfile
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def plain(value):
    if isinstance(value, decimal.Decimal):
        return value.normalize() if value else decimal.Decimal(0)
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def normalized(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        (tuple(plain(row[i]) for i in order) for row in rows), key=lambda r: tuple((v is None, str(v)) for v in r)
    )


def kind(value):
    if isinstance(value, bool) or value is None:
        return type(value)
    return {int: "int", float: "float", decimal.Decimal: "decimal"}.get(type(value), type(value))


def compare(connection, spark, sf_dir, run, sql) -> str:
    """Empty when the results agree, else what differs."""
    result = run(spark, sf_dir)
    got = normalized(result.columns, [tuple(r) for r in result.collect()])
    cursor = connection.execute(sql)
    want = normalized([d[0] for d in cursor.description], cursor.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"{len(got[1])} rows != {len(want[1])}"
    for a, b in zip(got[1], want[1]):
        if a != b:
            return f"first difference {[(c, x, y) for c, x, y in zip(got[0], a, b) if x != y]}"
        for column, x, y in zip(got[0], a, b):
            if x is not None and y is not None and kind(x) != kind(y):
                return f"{column}: {x!r} and {y!r} differ in type"
    return ""


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from pyspark.sql import SparkSession

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:]
    shared = tempfile.TemporaryDirectory(prefix="oracle-")  # one machine: its own folder is shared
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.checkpoint.dir", f"{shared.name}/shared")
        .config("spark.sql.warehouse.dir", f"{shared.name}/warehouse")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    connection, oracles, bad = connect(sf_dir), oracle_sql(), 0
    for name, run in queries().items():
        if chosen and name not in chosen:
            continue
        started = time.time()
        try:
            if name not in oracles:
                outcome = f"no SQL; {run(spark, sf_dir).count()} rows"
            else:
                outcome = compare(connection, spark, sf_dir, run, oracles[name])
                bad += bool(outcome)
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            outcome, bad = f"{type(error).__name__}: {str(error)[:400]}", bad + 1
        print(f"{name:28s} {time.time() - started:6.2f}s {outcome or 'ok'}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
