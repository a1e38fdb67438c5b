"""Run registered queries next to their SQL and compare whole results."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        table = os.path.basename(path)[: -len(".parquet")]
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    return connection


def normal(rows: list[tuple]) -> list[tuple]:
    def cell(value):
        if value is None or value is pd.NaT:
            return "~"
        if isinstance(value, float):
            return repr(value)
        return str(value)
    return sorted(tuple(cell(v) for v in row) for row in rows)


SPARK_TYPES = {
    "BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double",
    "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz", "DATE": "date",
}


def compare(df, connection, sql: str) -> list[str]:
    """Differences between a Spark result and the SQL's; empty if they agree."""
    columns = sorted(df.columns)
    relation = connection.sql(sql)
    if columns != sorted(relation.columns):
        return [f"columns {columns} != {sorted(relation.columns)}"]
    problems = []
    expected_types = dict(zip(relation.columns, map(str, relation.types)))
    for name, dtype in df.dtypes:
        if SPARK_TYPES.get(expected_types[name]) != dtype:
            problems.append(f"type of {name}: {dtype} != {expected_types[name]}")
    got = normal([tuple(r) for r in df.select(*columns).collect()])
    want = normal(relation.select(*(f'"{c}"' for c in columns)).fetchall())
    if len(got) != len(want):
        problems.append(f"rows {len(got)} != {len(want)}")
    if got != want:
        extra = list(set(got) - set(want))[:2]
        missing = list(set(want) - set(got))[:2]
        problems.append(f"values differ: only Spark {extra}, only SQL {missing}")
    if not want:
        problems.append("empty result")
    return problems


def main(sf_dir: str, names: list[str]) -> int:
    import __spark_entry__ as entry
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = duck(sf_dir)
    oracles, bad = entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        began = time.time()
        try:
            df = query(spark, sf_dir)
            if name in oracles:
                problems = compare(df, connection, oracles[name])
                rows = len(connection.sql(oracles[name]).fetchall())
            else:
                problems, rows = [], df.count()
        except Exception as error:  # noqa: BLE001
            problems, rows = [f"{type(error).__name__}: {str(error)[:600]}"], -1
        bad += bool(problems)
        verdict = "ok" if not problems else "FAIL " + "; ".join(problems)
        print(f"{name:28s} {rows:7d} rows {time.time() - began:6.2f} s  {verdict}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
