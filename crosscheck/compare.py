"""Run queries and their SQL side by side: ``python -m crosscheck.compare SF_DIR [name ...]``."""

from __future__ import annotations

import datetime
import math
import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

from crosscheck.registry import ORACLES, QUERIES
from emploiscope.session import build_session


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'").fetchall()
    return connection


def _plain(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(value)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return repr(value)


def _rows(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(df: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty when names, types and all rows agree, otherwise a short description."""
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    expected = _rows(names, result.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    kinds = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN", "date": "DATE"}
    wrong = {n: (t, types[n]) for n, t in df.dtypes if kinds.get(t) != types[n]}
    actual = _rows(df.columns, df.collect())
    if actual != expected:
        here, there = set(actual), set(expected)
        extra, missing = sorted(here - there)[:3], sorted(there - here)[:3]
        return f"{len(actual)} rows against {len(expected)}; only here {extra}; only SQL {missing}"
    return f"types {wrong}" if wrong else ""


def main(sf_dir: str, names: list[str]) -> int:
    spark = build_session("crosscheck", "local[4]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    failed = 0
    for name in names or QUERIES:
        started = time.time()
        try:
            problem = differences(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLES[name])
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - started:.2f}s {problem[:2500]}", flush=True)
    print(f"{failed} of {len(names or QUERIES)} failed")
    return failed


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1], sys.argv[2:])))
