"""Run registered queries and their SQL side by side: ``python -m checks.compare FOLDER [NAME...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from checks import oracle, registered


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def differences(spark: SparkSession, con, folder: str, name: str) -> str | None:
    """None when rows, column names and values agree."""
    found = registered.queries()[name](spark, folder)
    columns = sorted(found.columns)
    wanted = con.execute(oracle.oracle_sql()[name])
    names = sorted(d[0] for d in wanted.description)
    if columns != names:
        return f"columns {columns} and {names}"
    order = [[d[0] for d in wanted.description].index(c) for c in columns]
    key = lambda row: [(v is None, str(v)) for v in row]
    left = sorted((tuple(r) for r in found.select(*columns).collect()), key=key)
    right = sorted((tuple(r[i] for i in order) for r in wanted.fetchall()), key=key)
    if left != right:
        pairs = [(a, b) for a, b in zip(left, right) if a != b][:3]
        return f"{len(left)} and {len(right)} rows, first differences {pairs}"
    return None


if __name__ == "__main__":
    folder, names = sys.argv[1], sys.argv[2:] or list(registered.queries())
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    for name in names:
        start = time.time()
        try:
            problem = differences(spark, con, folder, name)
        except Exception as error:  # report and go on
            problem = str(error)[:500]
        print(f"{'ok  ' if problem is None else 'DIFF'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
