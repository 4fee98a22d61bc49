"""Season arithmetic as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the first month of a season.
START_MONTH = 10


def season_year(date: Column, start_month: int = START_MONTH) -> Column:
    """Year in which the season of ``date`` began; months before the start belong to the last one."""
    return F.year(date) - (F.month(date) < start_month).cast("int")


def season_of(date: Column, start_month: int = START_MONTH) -> Column:
    """Season of a date in the short form, such as 2025."""
    return season_year(date, start_month).cast("string")


def season_to_long(season: Column) -> Column:
    """2025 -> 20252026."""
    year = season.cast("int")
    return F.concat(year.cast("string"), (year + 1).cast("string"))


def season_to_short(season: Column) -> Column:
    """20252026 -> 2025; a short season stays as it is."""
    return F.substring(season, 1, 4)


def current_season(spark_date: Column | None = None) -> Column:
    """Season of today, or of the date given."""
    return season_of(F.current_date() if spark_date is None else spark_date)


def current_season_long(spark_date: Column | None = None) -> Column:
    return season_to_long(current_season(spark_date))
