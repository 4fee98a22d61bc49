import json

from pyspark.sql import functions as F

from snaphist.operators.flatten import parse_documents, to_members, with_lineage
from snaphist.schemas import BRONZE
from tests.helpers import at, rows

FULL = {
    "forwards": [
        {
            "id": 8478402,
            "firstName": {"default": "Connor"},
            "lastName": {"default": "Mc David\t"},
            "birthDate": {"default": "1997-01-13"},
            "sweaterNumber": 97,
            "positionCode": "L",
            "shootsCatches": "L",
            "heightInInches": 73,
            "weightInPounds": 194,
            "birthCity": {"default": "Richmond Hill"},
            "birthCountry": "CAN",
            "nationality": {"default": "CAN"},
            "captain": True,
        }
    ],
    "defensemen": [{"firstName": {"default": "Solo"}, "birthDate": "1990-01-01"}],
    "goalies": [{"id": None, "sweaterNumber": None, "positionCode": None, "lastName": None}],
}


def parse(spark, documents, **options):
    docs = spark.createDataFrame(
        [(f"G{i}", "2025", at(1), d if isinstance(d, str) else json.dumps(d)) for i, d in enumerate(documents)],
        "group_id STRING, season STRING, run_ts TIMESTAMP_NTZ, payload STRING",
    )
    return with_lineage(parse_documents(docs, **options), "r1", F.col("run_ts"), "src")


def test_all_sections(spark):
    members = to_members(parse(spark, [FULL]))
    assert members.schema.names == BRONZE.names
    assert rows(members, "position_group", "member_id", "full_name", "number", "position", "birth_date") == [
        ("Defenseman", "", "Solo", "N/A", "N/A", "1990-01-01"),
        ("Forward", "8478402", "Connor Mc David", "97", "LW", "1997-01-13"),
        ("Goalie", "", "", "N/A", "N/A", ""),
    ]
    forward = members.where("position_group = 'Forward'").first()
    assert forward["height"] == "73" and forward["weight"] == "194"
    assert forward["captain"] is True and forward["rookie"] is False
    assert forward["birth_city"] == "Richmond Hill" and forward["nationality"] == "CAN"
    assert forward["member_url"].endswith("/8478402")
    assert forward["run_id"] == "r1" and forward["source"] == "src" and forward["run_ts"] == at(1)
    assert forward["age"] is None and forward["summary"] is None
    solo = members.where("position_group = 'Defenseman'").first()
    assert solo["birth_city"] is None and solo["birth_country"] == "" and solo["height"] == "N/A"


def test_missing_and_empty_sections_add_nothing(spark):
    parsed = parse(spark, [{"goalies": FULL["forwards"]}, {"forwards": [], "goalies": None}, {}])
    assert rows(to_members(parsed), "group_id", "position_group") == [("G0", "Goalie")]
    assert rows(parsed, "group_id", "is_corrupt") == [("G0", False), ("G1", False), ("G2", False)]


def test_unreadable_document_does_not_disturb_others(spark):
    parsed = parse(spark, ['{"forwards": [', FULL])
    assert rows(parsed.where("is_corrupt"), "group_id", "section") == [("G0", None)]
    assert to_members(parsed).count() == 3


def test_keep_raw_gives_the_same_members_and_their_text(spark):
    plain = to_members(parse(spark, [FULL])).drop("raw")
    kept = to_members(parse(spark, [FULL], keep_raw=True))
    assert rows(kept.drop("raw")) == rows(plain)
    raw = kept.where("position_group = 'Forward'").first()["raw"]
    assert json.loads(raw) == FULL["forwards"][0]
