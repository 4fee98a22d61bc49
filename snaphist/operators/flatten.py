"""From nested snapshot documents to member rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from snaphist.functions import codes, text
from snaphist.schemas import BRONZE, DOCUMENT_MEMBER, to_schema

CORRUPT = "_corrupt_record"


def document_schema(
    member: StructType = DOCUMENT_MEMBER,
    sections: Mapping[str, str] = codes.SECTIONS,
    keep_raw: bool = False,
) -> StructType:
    """A document's sections; with ``keep_raw`` members stay JSON text at first."""
    element = StringType() if keep_raw else member
    fields = [StructField(s, ArrayType(element)) for s in sections]
    return StructType([*fields, StructField(CORRUPT, StringType())])


def explode_sections(
    df: DataFrame, document: Column, sections: Mapping[str, str] = codes.SECTIONS
) -> DataFrame:
    """One row per member of any section, with columns ``section`` and ``member``.

    A missing section adds no rows; a document without members gives one row with NULLs.
    """

    def tagged(name: str, tag: str) -> Column:
        entry = lambda m: F.struct(F.lit(tag).alias("section"), m.alias("member"))
        return F.transform(document.getField(name), entry)

    members = F.flatten(F.array_compact(F.array(*[tagged(*s) for s in sections.items()])))
    kept = [c for c in df.columns]
    return df.select(*kept, F.explode_outer(members).alias("_m")).select(
        *kept, F.col("_m.section").alias("section"), F.col("_m.member").alias("member")
    )


def parse_documents(
    docs: DataFrame,
    member: StructType = DOCUMENT_MEMBER,
    sections: Mapping[str, str] = codes.SECTIONS,
    keep_raw: bool = False,
) -> DataFrame:
    """Parse ``payload`` and explode its members.

    Adds ``section``, ``member`` and ``is_corrupt``; a document that cannot be parsed gives a
    single row that says so and does not disturb the others.
    """
    schema = document_schema(member, sections, keep_raw)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    kept = [c for c in docs.columns if c != "payload"]
    parsed = docs.select(*kept, F.from_json("payload", schema, options).alias("_doc"))
    corrupt = F.col("_doc").isNull() | F.col(f"_doc.{CORRUPT}").isNotNull()
    rows = explode_sections(
        parsed.withColumn("is_corrupt", corrupt),
        F.when(~F.col("is_corrupt"), F.col("_doc")),
        sections,
    ).drop("_doc")
    if keep_raw:
        rows = rows.withColumn("raw", F.col("member")).withColumn(
            "member", F.from_json("raw", member)
        )
    return rows


def member_columns(member: Column, url_prefix: str = codes.MEMBER_URL_PREFIX) -> dict[str, Column]:
    """The attributes of a member record, from its parsed document entry."""

    def field(name: str) -> Column:
        return member.getField(name)

    member_id = F.coalesce(field("id"), F.lit(""))
    no = F.lit(False)
    return {
        "member_id": member_id,
        "member_url": F.concat(F.lit(url_prefix), member_id),
        "number": text.text_or_missing(field("sweaterNumber")),
        "full_name": text.localized_name(field("firstName"), field("lastName")),
        "position": codes.normalize_code(
            text.text_or_missing(field("positionCode")), codes.POSITION_ALIASES
        ),
        "height": text.text_or_missing(field("heightInInches")),
        "weight": text.text_or_missing(field("weightInPounds")),
        "shoots_catches": text.text_or_missing(field("shootsCatches")),
        "birth_date": text.object_or_scalar(field("birthDate")),
        "birth_city": field("birthCity").getField("default"),
        "birth_country": F.coalesce(field("birthCountry"), F.lit("")),
        "nationality": field("nationality").getField("default"),
        "rookie": F.coalesce(field("rookie"), no),
        "current_age": field("currentAge"),
        "captain": F.coalesce(field("captain"), no),
        "alternate_captain": F.coalesce(field("alternateCaptain"), no),
    }


def with_lineage(df: DataFrame, run_id: str, run_ts: Column, source: str) -> DataFrame:
    """Stamp rows with their run: one id and one time for the whole batch."""
    return df.withColumns({"run_id": F.lit(run_id), "run_ts": run_ts, "source": F.lit(source)})


def to_members(parsed: DataFrame) -> DataFrame:
    """Member records of the bronze layout, set hash and load time still open."""
    return to_schema(
        parsed.where(F.col("member").isNotNull()).withColumns(
            {**member_columns(F.col("member")), "position_group": F.col("section")}
        ),
        BRONZE,
    )
