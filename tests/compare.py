"""Runs a named query and its SQL on the same tables and compares them."""

from collections import Counter
from pathlib import Path

import duckdb


def duck(sf_dir: str):
    connection = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def spark_rows(frame) -> tuple[list[str], Counter]:
    columns = sorted(frame.columns)
    return columns, Counter(tuple(row) for row in frame.select(*columns).collect())


def sql_rows(connection, sql: str) -> tuple[list[str], Counter]:
    relation = connection.sql(sql)
    columns = sorted(relation.columns)
    return columns, Counter(relation.select(*[f'"{name}"' for name in columns]).fetchall())
