"""Side-by-side comparison of the catalog's queries with their SQL, as a function and a command."""

from __future__ import annotations

import math
import sys
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def _value(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


def canonical(columns: list[str], rows) -> tuple[list[str], list[str]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(repr(tuple(_value(row[i]) for i in order)) for row in rows)


def spark_rows(df):
    return canonical(df.columns, df.collect())


def sql_rows(connection, sql: str):
    cursor = connection.execute(sql)
    columns = [d[0] for d in cursor.description]
    return canonical(columns, cursor.fetchall())


def difference(spark_result, sql_result) -> str:
    """Empty if equal, else a description."""
    if spark_result[0] != sql_result[0]:
        return f"columns {spark_result[0]} != {sql_result[0]}"
    ours, theirs = spark_result[1], sql_result[1]
    if ours == theirs:
        return ""
    only_ours = sorted(set(ours) - set(theirs))[:2]
    only_theirs = sorted(set(theirs) - set(ours))[:2]
    return f"{len(ours)} rows against {len(theirs)}; only here {only_ours}; only there {only_theirs}"


if __name__ == "__main__":
    import time

    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    from pyspark.sql import SparkSession

    from sievework.catalog.oracle import ORACLE_SQL
    from sievework.catalog.queries import QUERIES

    sf_dir, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    for name in names:
        started = time.time()
        try:
            ours = spark_rows(QUERIES[name](spark, sf_dir))
            seconds = time.time() - started
            found = difference(ours, sql_rows(connection, ORACLE_SQL[name])) if name in ORACLE_SQL else "no SQL"
        except Exception as exc:  # noqa: BLE001
            found, seconds = f"{type(exc).__name__}: {str(exc)[:500]}", time.time() - started
        print("ok  " if not found else "DIFF", name, f"{seconds:.2f}s", found, flush=True)
