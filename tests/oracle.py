"""Compare a Spark result with DuckDB SQL over the same parquet tables."""

import datetime as dt
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def spark_rows(df: DataFrame) -> Counter:
    names = sorted(df.columns)
    return Counter(tuple(_plain(v) for v in row) for row in df.select(*names).collect())


def sql_rows(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], Counter]:
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = Counter(tuple(_plain(row[i]) for i in order) for row in result.fetchall())
    return [columns[i] for i in order], rows
