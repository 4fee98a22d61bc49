from snaphist.operators.quality import STANDARD_SUITE, ModelTests, run_suite
from tests.helpers import rows


def test_counts_failures(spark):
    df = spark.createDataFrame(
        [(1, "a"), (1, None), (2, "b"), (None, "b"), (None, "b")], "k INT, v STRING"
    )
    got = run_suite({"m": df}, {"m": ModelTests(not_null=("k", "v"), unique=("k", "v"))})
    assert rows(got) == [
        ("m", "k", "not_null", 2, False),
        ("m", "k", "unique", 1, False),
        ("m", "v", "not_null", 1, False),
        ("m", "v", "unique", 1, False),
    ]


def test_empty_table_passes(spark):
    df = spark.createDataFrame([], "k INT")
    got = run_suite({"m": df}, {"m": ModelTests(not_null=("k",), unique=("k",))})
    assert [r[3:] for r in rows(got)] == [(0, True), (0, True)]


def test_standard_suite_has_twelve_tests():
    assert sum(len(t.not_null) + len(t.unique) for t in STANDARD_SUITE.values()) == 12
