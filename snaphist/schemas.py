"""Table definitions and the cast, order and default step that conforms rows to them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

# Fixed value: the end date of a version that is still open.
FOREVER = "9999-12-31 00:00:00"


STRING, BOOLEAN, INT, BIGINT = StringType(), BooleanType(), IntegerType(), LongType()
TIMESTAMP = TimestampNTZType()
LOCALIZED = StructType([StructField("default", STRING)])


# One member inside a section of a snapshot document. Numbers are declared as
# text because the model keeps them as text; birthDate may be an object or a scalar.
DOCUMENT_MEMBER = StructType(
    [
        StructField("id", STRING),
        StructField("firstName", LOCALIZED),
        StructField("lastName", LOCALIZED),
        StructField("birthDate", STRING),
        StructField("sweaterNumber", STRING),
        StructField("positionCode", STRING),
        StructField("shootsCatches", STRING),
        StructField("heightInInches", STRING),
        StructField("weightInPounds", STRING),
        StructField("birthCity", LOCALIZED),
        StructField("birthCountry", STRING),
        StructField("nationality", LOCALIZED),
        StructField("rookie", BOOLEAN),
        StructField("currentAge", STRING),
        StructField("captain", BOOLEAN),
        StructField("alternateCaptain", BOOLEAN),
    ]
)

# The columns of the loaded tables.
RAW_MEMBERS = StructType(
    [
        StructField("group_id", STRING),
        StructField("season", STRING),
        StructField("run_id", STRING),
        StructField("run_ts", TIMESTAMP),
        StructField("source", STRING),
        StructField("member_id", STRING),
        StructField("member_url", STRING),
        StructField("number", STRING),
        StructField("full_name", STRING),
        StructField("position", STRING),
        StructField("age", STRING),
        StructField("height", STRING),
        StructField("weight", STRING),
        StructField("shoots_catches", STRING),
        StructField("experience", STRING),
        StructField("birth_date", STRING),
        StructField("summary", STRING),
        StructField("set_hash", STRING),
        StructField("bronze_loaded_at", TIMESTAMP),
        StructField("load_ts", TIMESTAMP),
    ]
)

BRONZE = StructType(
    [
        StructField("group_id", STRING),
        StructField("season", STRING),
        StructField("run_id", STRING),
        StructField("run_ts", TIMESTAMP),
        StructField("source", STRING),
        StructField("member_id", STRING),
        StructField("member_url", STRING),
        StructField("number", STRING),
        StructField("full_name", STRING),
        StructField("position", STRING),
        StructField("age", STRING),
        StructField("height", STRING),
        StructField("weight", STRING),
        StructField("shoots_catches", STRING),
        StructField("experience", STRING),
        StructField("birth_date", STRING),
        StructField("summary", STRING),
        StructField("birth_city", STRING),
        StructField("birth_country", STRING),
        StructField("nationality", STRING),
        StructField("rookie", BOOLEAN),
        StructField("current_age", STRING),
        StructField("captain", BOOLEAN),
        StructField("alternate_captain", BOOLEAN),
        StructField("games_played", STRING),
        StructField("goals", STRING),
        StructField("assists", STRING),
        StructField("points", STRING),
        StructField("plus_minus", STRING),
        StructField("penalty_minutes", STRING),
        StructField("time_on_ice", STRING),
        StructField("position_group", STRING),
        StructField("raw", STRING),
        StructField("set_hash", STRING),
        StructField("bronze_loaded_at", TIMESTAMP),
    ]
)

MANIFEST = StructType(
    [
        StructField("group_id", STRING),
        StructField("season", STRING),
        StructField("run_id", STRING),
        StructField("set_hash", STRING),
        StructField("member_count", INT),
        StructField("run_ts", TIMESTAMP),
        StructField("source", STRING),
        StructField("files", StructType([StructField("bronze", STRING), StructField("payload", STRING)])),
    ]
)

STATE = StructType(
    [
        StructField("group_id", STRING),
        StructField("season", STRING),
        StructField("current_hash", STRING),
        StructField("last_ingested", TIMESTAMP),
        StructField("last_run_id", STRING),
        StructField("member_count", INT),
        StructField("updated_at", TIMESTAMP),
    ]
)

CHANGE_LOG = StructType(
    [
        StructField("run_id", STRING),
        StructField("group_id", STRING),
        StructField("season", STRING),
        StructField("changed", BOOLEAN),
        StructField("current_hash", STRING),
        StructField("previous_hash", STRING),
        StructField("member_count", INT),
        StructField("run_ts", TIMESTAMP),
        StructField("decision", STRING),
    ]
)

PAYLOADS = StructType(
    [
        StructField("group_id", STRING),
        StructField("season", STRING),
        StructField("run_id", STRING),
        StructField("run_ts", TIMESTAMP),
        StructField("payload_kind", STRING),
        StructField("payload", STRING),
    ]
)

RUNS = StructType(
    [
        StructField("run_id", STRING),
        StructField("run_ts", TIMESTAMP),
        StructField("state_version", BIGINT),
        StructField("total_groups", BIGINT),
        StructField("total_members", BIGINT),
        StructField("groups_with_bronze", BIGINT),
        StructField("groups_failed", BIGINT),
        StructField("groups_in_error", BIGINT),
    ]
)

# Where the parts of a table are: the version that holds each bucket, and with a NULL bucket those that only add.
INDEX = StructType([StructField("bucket", INT), StructField("version", BIGINT)])

# The same per bucket of a history: which batch holds its versions and which hold rows of it.
HISTORY_INDEX = StructType([StructField("kind", STRING), StructField("bucket", INT), StructField("number", BIGINT)])

KEY_BATCHES = StructType([StructField("batch", BIGINT), StructField("run_id", STRING), StructField("last_number", BIGINT)])

SKETCHES = StructType(
    [
        StructField("group_id", STRING),
        StructField("season", STRING),
        StructField("run_id", STRING),
        StructField("run_ts", TIMESTAMP),
        StructField("sketch", BinaryType()),
        StructField("member_rows", BIGINT),
    ]
)

LEDGER = StructType(
    [
        StructField("group_id", STRING),
        StructField("season", STRING),
        StructField("run_ts", TIMESTAMP),
        StructField("digest", STRING),
        StructField("run_id", STRING),
    ]
)

SETTINGS = StructType([StructField("hash_form", STRING)])

POINTER = StructType([StructField("number", BIGINT), StructField("version", STRING)])


def to_schema(
    df: DataFrame, schema: StructType, defaults: dict[str, Column] | None = None
) -> DataFrame:
    """Keep the columns ``schema`` knows, in its order and types; absent ones get a default or NULL."""
    defaults = defaults or {}
    have = set(df.columns)
    columns = []
    for field in schema:
        if field.name in have:
            value = F.col(field.name)
            if field.name in defaults:
                value = F.coalesce(value, defaults[field.name])
        else:
            value = defaults.get(field.name, F.lit(None))
        columns.append(value.cast(field.dataType).alias(field.name))
    return df.select(columns)
