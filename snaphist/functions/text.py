"""Scalar text expressions. All are built-in Column expressions; none leaves the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters a Unicode-aware strip removes from both ends.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Fixed value: what a missing attribute reads as.
MISSING = "N/A"


def strip(column: Column) -> Column:
    """Remove white space of any kind from both ends (plain ``trim`` removes blanks only)."""
    return F.btrim(column, F.lit(WHITESPACE))


def localized(column: Column) -> Column:
    """Text of a localised value, '' when absent."""
    return F.coalesce(column.getField("default"), F.lit(""))


def localized_name(first: Column, last: Column) -> Column:
    """Full name from two localised parts."""
    return strip(F.concat(localized(first), F.lit(" "), localized(last)))


def object_or_scalar(column: Column) -> Column:
    """Text of a value that arrives either as ``{"default": v}`` or as a plain scalar."""
    value = F.when(
        F.startswith(F.ltrim(column), F.lit("{")), F.get_json_object(column, "$.default")
    ).otherwise(column)
    return F.coalesce(value, F.lit(""))


def text_or_missing(column: Column) -> Column:
    """Attribute as text; an absent key and an explicit null both read as missing."""
    return F.coalesce(column.cast("string"), F.lit(MISSING))


def fallback_id(member_id: Column, full_name: Column) -> Column:
    """The id, or one made from the name where the id is NULL or empty."""
    return F.coalesce(
        F.nullif(member_id, F.lit("")),
        F.concat(F.lit("unknown_"), F.replace(full_name, F.lit(" "), F.lit("_"))),
    )


def first_token(full_name: Column) -> Column:
    return F.split_part(full_name, F.lit(" "), F.lit(1))


def last_token(full_name: Column) -> Column:
    return F.split_part(full_name, F.lit(" "), F.lit(-1))


def payload_kind(payload: Column) -> Column:
    """'json' where the first character after white space opens an object or array, else 'html'."""
    head = strip(payload)
    is_json = F.startswith(head, F.lit("{")) | F.startswith(head, F.lit("["))
    return F.when(is_json, F.lit("json")).otherwise(F.lit("html"))
