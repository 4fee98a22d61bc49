"""Compare a Spark result with DuckDB's answer as multisets of rows."""

from __future__ import annotations

import datetime
import math
from collections import Counter
from pathlib import Path

import duckdb


def connect(sf_dir: str):
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def _value(v):
    if isinstance(v, float) and not math.isnan(v):
        return round(v, 9)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return v


def rows_of(columns, rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(
        tuple(_value(row[i]) for i in order) for row in rows
    )


KINDS = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
    "double": "DOUBLE",
}


def compare(df, connection, sql: str) -> list[str]:
    """Differences in columns, types and rows; an empty list if there are none."""
    answer = connection.execute(sql)
    description = [(d[0], str(d[1])) for d in answer.description]
    want_columns, want = rows_of([d[0] for d in description], answer.fetchall())
    have_columns, have = rows_of(df.columns, df.collect())
    problems = []
    if have_columns != want_columns:
        return [f"columns {have_columns} != {want_columns}"]
    kinds = dict(description)
    for name, kind in df.dtypes:
        if KINDS.get(kind) != kinds[name]:
            problems.append(f"type of {name}: {kind} != {kinds[name]}")
    if not have:
        problems.append("no rows")
    for row, n in list((have - want).items())[:3]:
        problems.append(f"only in Spark x{n}: {row}")
    for row, n in list((want - have).items())[:3]:
        problems.append(f"only in SQL x{n}: {row}")
    return problems
