"""Run registered queries against their DuckDB texts: python -m checks.compare FOLDER [NAME ...]"""

from __future__ import annotations

import sys
import time

import duckdb
from pyspark.sql import SparkSession

from checks.queries import ORACLES, QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(v):
        if isinstance(v, float):
            return f"{v + 0.0:.9f}".replace("-0.000000000", "0.000000000")
        return str(v)

    return sorted(tuple(cell(row[i]) for i in order) for row in rows), [columns[i] for i in order]


def duck(folder: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def differences(spark, connection, folder, name) -> str | None:
    """None if both engines agree, otherwise what differs."""
    result = QUERIES[name](spark, folder)
    got, got_columns = canonical(result.columns, [tuple(r) for r in result.collect()])
    if name not in ORACLES:
        return None if got else "no rows"
    cursor = connection.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    want, want_columns = canonical(columns, cursor.fetchall())
    if got_columns != want_columns:
        return f"columns {set(got_columns) ^ set(want_columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            return str([(c, x, y) for c, x, y in zip(got_columns, a, b) if x != y][:5])
    return None


def session(cores: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main(folder: str, names: list[str]) -> int:
    spark, connection, bad = session(), duck(folder), 0
    for name in names or list(QUERIES):
        start = time.time()
        try:
            problem = differences(spark, connection, folder, name)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{name:34s} {time.time() - start:6.1f}s {'ok' if problem is None else problem}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
