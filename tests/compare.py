"""Run queries and their SQL side by side: ``python tests/compare.py [key ...]``."""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def oracle_connection(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def oracle_rows(connection, sql: str) -> tuple[list[str], list[tuple], list[str]]:
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    kinds = [str(d[1]).lower() for d in cursor.description]
    return _sorted(names, cursor.fetchall(), kinds)


def spark_rows(df) -> tuple[list[str], list[tuple], list[str]]:
    return _sorted(df.columns, [tuple(r) for r in df.collect()], [t for _, t in df.dtypes])


def _plain(value):
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else value + 0.0
    if isinstance(value, int):
        return value
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    return str(value)


def _sorted(names, rows, kinds):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    plain.sort(key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r))
    return [names[i] for i in order], plain, [kinds[i] for i in order]


def difference(left, right) -> str | None:
    """Why two results differ, or nothing."""
    if left[0] != right[0]:
        return f"columns {left[0]} / {right[0]}"
    if len(left[1]) != len(right[1]):
        return f"rows {len(left[1])} / {len(right[1])}"
    for a, b in zip(left[1], right[1]):
        if a != b:
            return f"first difference {a} / {b}"
    return None


def session():
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[8]").appName("compare")
        .config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g").config("spark.sql.session.timeZone", os.environ.get("TZ_TEST", "UTC"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main(keys: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries

    folder = os.environ.get("COMPARE_SF_DIR", "/root/testdata/sf0.01")
    spark, connection = session(), oracle_connection(folder)
    sql, bad = oracle_sql(), 0
    for key, function in queries().items():
        if keys and key not in keys:
            continue
        start = time.time()
        try:
            left = spark_rows(function(spark, folder))
            spent = time.time() - start
            if key not in sql:
                print(f"ROWS {key} {len(left[1])} {spent:.2f}s")
                continue
            right = oracle_rows(connection, sql[key])
            problem = difference(left, right)
        except Exception as error:  # noqa: BLE001 - report and go on
            problem, left, right, spent = f"{type(error).__name__}: {str(error)[:600]}", ([], [], []), ([], [], []), 0
        bad += problem is not None
        print(f"{'OK  ' if problem is None else 'DIFF'} {key} {len(left[1])} {spent:.2f}s {problem or ''}", flush=True)
        if os.environ.get("SHOW_TYPES"):
            print("     ", list(zip(left[0], left[2], right[2])))
    print(f"{bad} differ")
    return bad


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1:])))
