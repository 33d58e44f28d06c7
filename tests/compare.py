"""Runs a registered query and its SQL side by side and compares them as multisets."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def duckdb_tables(sf_dir: str):
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        files = path / "*.parquet" if path.is_dir() else path
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{files}'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return repr(value)


def _table(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def spark_side(df):
    return _table(df.columns, [tuple(row) for row in df.collect()])


def sql_side(connection, sql):
    cursor = connection.execute(sql)
    names = [column[0] for column in cursor.description]
    return _table(names, cursor.fetchall())
