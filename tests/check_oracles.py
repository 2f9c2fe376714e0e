"""Compares queries with their SQL: ``python -m tests.check_oracles [sf_dir] [name ...]``."""

from __future__ import annotations

import sys
import time

import duckdb
from pyspark.sql import SparkSession

import __spark_entry__ as contract

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
)


def oracle_connection(sf_dir):
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES.split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def normal(value):
    return f"{value:.12g}" if isinstance(value, float) else str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(normal(row[i]) for i in order) for row in rows)


KINDS = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "timestamp": "TIMESTAMP", "boolean": "BOOLEAN"}


def differences(spark, connection, sf_dir, name):
    """Empty when query and SQL agree on columns, types and rows."""
    df = contract.queries()[name](spark, sf_dir)
    result = connection.execute(contract.oracle_sql()[name])
    types = {d[0]: str(d[1]) for d in result.description}
    wrong = [f"type of {c}: {t}, SQL {types.get(c)}" for c, t in df.dtypes if KINDS.get(t, t) != types.get(c)]
    found = rows_of(df.columns, df.collect())
    expected = rows_of(list(types), result.fetchall())
    if found[0] != expected[0]:
        wrong.append(f"columns {found[0]}, SQL {expected[0]}")
    if found[1] != expected[1]:
        left, right = set(found[1]), set(expected[1])
        wrong.append(f"{len(found[1])} rows, SQL {len(expected[1])}; only here {sorted(left - right)[:2]}, only SQL {sorted(right - left)[:2]}")
    return wrong, len(found[1])


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(contract.oracle_sql())
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = oracle_connection(sf_dir)
    for name in names:
        start = time.time()
        try:
            wrong, count = differences(spark, connection, sf_dir, name)
        except Exception as problem:
            wrong, count = [f"{type(problem).__name__}: {str(problem)[:600]}"], 0
        print(f"{'ok  ' if not wrong else 'FAIL'} {name} {count} rows {time.time() - start:.1f}s", *wrong, sep="\n     ", flush=True)


if __name__ == "__main__":
    main()
