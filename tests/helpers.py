from __future__ import annotations

import datetime
import re

from pyspark.sql import DataFrame


def at(day: int, hour: int = 0) -> datetime.datetime:
    return datetime.datetime(2024, 1, day, hour)


def rows(df: DataFrame, *columns: str) -> list[tuple]:
    """All rows as sorted tuples, NULLs last."""
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=lambda r: [(v is None, str(v)) for v in r])


def same(a: DataFrame, b: DataFrame) -> bool:
    b = b.select(*a.columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def plan(df: DataFrame) -> str:
    return re.sub(r"#\d+L?", "", df._jdf.queryExecution().executedPlan().toString())
