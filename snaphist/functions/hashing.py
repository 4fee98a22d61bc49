"""Row and member hashes as Column expressions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from snaphist.functions.text import strip

# Separators inside the hashed texts.
FIELD_SEPARATOR = "|"
MEMBER_SEPARATOR = "||"


def as_text(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(""))


def row_text(columns: Iterable[str]) -> Column:
    """The tracked attributes of one row as one text, NULL read as ''."""
    return F.concat_ws(FIELD_SEPARATOR, *[as_text(F.col(c)) for c in columns])


def row_hash(columns: Iterable[str]) -> Column:
    """md5 over the tracked attributes of one row."""
    return F.md5(row_text(columns))


def member_text(fields: Sequence[Column]) -> Column:
    """One member as it enters the set hash: stripped fields in order."""
    return F.concat_ws(FIELD_SEPARATOR, *[strip(field) for field in fields])


def member_bits(fields: Sequence[str], seed: int) -> Column:
    """64 hash bits of one member, from its stripped fields."""
    return F.xxhash64(F.lit(seed), *fields)


def bit_chunks(bits: Column) -> list[Column]:
    """64 bits as three numbers below 2^22: their sum as longs is exact beyond 2^40 members."""
    return [
        F.shiftrightunsigned(bits, 42),
        F.shiftrightunsigned(bits, 21).bitwiseAND(F.lit(2**21 - 1)),
        bits.bitwiseAND(F.lit(2**21 - 1)),
    ]
