"""Times without zone, in UTC, whatever the session's time zone."""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def moment(value: str | datetime.datetime | Column) -> Column:
    """A given time; a datetime with a zone is converted to UTC, one without is taken as UTC."""
    if isinstance(value, Column):
        return value
    if isinstance(value, datetime.datetime):
        if value.tzinfo is not None:
            value = value.astimezone(datetime.timezone.utc).replace(tzinfo=None)
        # As text: a datetime literal would be read in the session's zone.
        value = value.isoformat(sep=" ")
    return F.lit(value).cast("timestamp_ntz")


def in_utc(column: Column) -> Column:
    """A point in time as its UTC clock reading."""
    return F.convert_timezone(
        F.current_timezone(), F.lit("UTC"), column.cast("timestamp_ntz")
    )


def utc_now() -> Column:
    return in_utc(F.current_timestamp())
