"""Comparing Spark results with DuckDB's."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = Path("/root/testdata")


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def rows_by_name(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plainer = [tuple(plain(r[i]) for i in order) for r in rows]
    return sorted(plainer, key=lambda r: tuple((v is not None, str(v)) for v in r))


def spark_rows(df) -> list[tuple]:
    return rows_by_name(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql: str) -> list[tuple]:
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    return rows_by_name(names, result.fetchall())
