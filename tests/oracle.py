"""Compares a Spark result with the same query's SQL run by DuckDB."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    return repr(value)


def rows_of(columns, rows) -> list[tuple]:
    """Rows with columns in name order, in an order that does not depend on the engine."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    return sorted(df.columns), rows_of(df.columns, df.collect())


def sql_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    return sorted(columns), rows_of(columns, result.fetchall())
