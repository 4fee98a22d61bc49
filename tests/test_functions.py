import datetime

import pytest
from pyspark.sql import functions as F

from snaphist.functions import codes, seasons, text, times
from snaphist.functions.hashing import row_hash


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_strip_removes_every_kind_of_white_space(spark):
    assert one(spark, text.strip(F.lit("\t\x0b a b 　\n"))) == "a b"
    assert one(spark, text.strip(F.lit(" \x85\xa0"))) == ""


def test_whitespace_is_what_python_strips():
    assert set(text.WHITESPACE) == {c for c in map(chr, range(0x3001)) if c.isspace()}


def test_object_or_scalar(spark):
    df = spark.createDataFrame(
        [('{"default": "1995-09-01"}',), ("1995-09-01",), ("",), (None,), ('{"x": 1}',)], "c STRING"
    )
    got = [r[0] for r in df.select(text.object_or_scalar(F.col("c"))).collect()]
    assert got == ["1995-09-01", "1995-09-01", "", "", ""]


def test_fallback_id(spark):
    df = spark.createDataFrame(
        [("7", "A B"), ("", "A B C"), (None, "X"), (None, None)], "id STRING, name STRING"
    )
    got = [r[0] for r in df.select(text.fallback_id(F.col("id"), F.col("name"))).collect()]
    assert got == ["7", "unknown_A_B_C", "unknown_X", None]


def test_name_tokens(spark):
    for name, first, last in [
        ("Ann Lee", "Ann", "Lee"),
        ("Ann B Lee", "Ann", "Lee"),
        ("Solo", "Solo", "Solo"),
        ("", "", ""),
        ("Trailing ", "Trailing", ""),
    ]:
        assert one(spark, text.first_token(F.lit(name))) == first
        assert one(spark, text.last_token(F.lit(name))) == last


def test_payload_kind(spark):
    for payload, kind in [
        (' \n{"a": 1}', "json"),
        ("[1]", "json"),
        ("<html>{}</html>", "html"),
        ("", "html"),
        ("　{", "json"),
    ]:
        assert one(spark, text.payload_kind(F.lit(payload))) == kind


def test_seasons(spark):
    def season(y, m, d):
        return one(spark, seasons.season_of(F.lit(datetime.date(y, m, d))))

    assert season(2025, 9, 30) == "2024"
    assert season(2025, 10, 1) == "2025"
    assert season(2026, 6, 30) == "2025"
    assert one(spark, seasons.season_to_long(F.lit("2025"))) == "20252026"
    assert one(spark, seasons.season_to_short(F.lit("20252026"))) == "2025"
    assert one(spark, seasons.season_to_short(F.lit("2025"))) == "2025"
    day = F.lit(datetime.date(2026, 1, 5))
    assert one(spark, seasons.current_season(day)) == "2025"
    assert one(spark, seasons.current_season_long(day)) == "20252026"
    assert len(one(spark, seasons.current_season())) == 4


@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles"])
def test_times_do_not_depend_on_the_session(spark, zone):
    noon = datetime.datetime(2024, 2, 5, 12)
    aware = noon.replace(tzinfo=datetime.timezone(datetime.timedelta(hours=2)))
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert one(spark, times.moment(noon)) == noon
        assert one(spark, times.moment("2024-02-05 12:00:00")) == noon
        assert one(spark, times.moment(aware)) == noon.replace(hour=10)
        utc = datetime.datetime.now(datetime.timezone.utc).replace(tzinfo=None)
        assert abs(one(spark, times.utc_now()) - utc) < datetime.timedelta(minutes=5)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_codes(spark):
    for code, normal in [("L", "LW"), ("R", "RW"), ("C", "C"), ("Z", "Z")]:
        assert one(spark, codes.normalize_code(F.lit(code), codes.POSITION_ALIASES)) == normal
    for code, group in [
        ("RW/C", "Forward"),
        ("D", "Defenseman"),
        ("G", "Goalie"),
        ("N/A", "Unknown"),
    ]:
        assert one(spark, codes.position_group(F.lit(code))) == group
    assert one(spark, codes.position_group(F.lit(None).cast("string"))) == "Unknown"
    assert len(codes.GROUP_NAMES) == 32


def test_row_hash_reads_null_as_empty(spark):
    df = spark.createDataFrame([(None, "b"), ("", "b"), ("b", None)], "x STRING, y STRING")
    first, second, third = [r[0] for r in df.select(row_hash(["x", "y"])).collect()]
    assert first == second != third
