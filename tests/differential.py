"""A query's rows from Spark and from DuckDB, in a form that can be compared."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

DATA = Path("/root/testdata")


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        source = f"{path}/*.parquet" if path.is_dir() else str(path)
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{source}')")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    return sorted(df.columns), rows_of(df.columns, df.collect())


def duck_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    got = con.execute(sql)
    columns = [d[0] for d in got.description]
    return sorted(columns), rows_of(columns, got.fetchall())
