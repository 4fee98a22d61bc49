import datetime
import hashlib
import random
from collections import defaultdict

from pyspark.sql import functions as F

from snaphist.operators.sethash import drop_unnamed, set_digest, set_hash, with_set_hash
from tests.helpers import rows, same

SCHEMA = "group_id STRING, full_name STRING, number STRING, position STRING"


def sample():
    rng = random.Random(7)
    names = ["Ann", " Ann", "Béla", "", " \t", "　", None, "Zoë ", "a", "A|B", "𐐷x", "￮x"]
    out = []
    for g in range(12):
        for _ in range(rng.randrange(1, 40)):
            out.append(
                (
                    f"g{g}",
                    rng.choice(names),
                    rng.choice(["1", "10", "2 ", None]),
                    rng.choice(["C", " D", ""]),
                )
            )
    return out + [("blank", " ", "1", "C")]


def brute_force(data):
    groups = defaultdict(list)
    for group, *fields in data:
        groups[group].append([f or "" for f in fields])
    result = {}
    for group, members in groups.items():
        texts = [
            "|".join(f.strip() for f in m) for m in sorted(members) if m[0].strip()
        ]
        result[group] = (hashlib.md5("||".join(texts).encode()).hexdigest(), len(members))
    return result


def test_equals_brute_force(spark):
    data = sample()
    got = set_hash(spark.createDataFrame(data, SCHEMA), ["group_id"])
    assert {r[0]: (r[1], r[2]) for r in got.collect()} == brute_force(data)
    assert brute_force(data)["blank"] == (hashlib.md5(b"").hexdigest(), 1)


def test_row_order_and_partitions_do_not_matter(spark):
    data = sample()
    shuffled = random.Random(1).sample(data, len(data))
    a, b = (spark.createDataFrame(d, SCHEMA) for d in (data, shuffled))
    for hash_of in (set_hash, set_digest):
        assert same(hash_of(a, ["group_id"]), hash_of(b.repartition(7), ["group_id"]))


def test_one_edit_changes_one_group(spark):
    data = sample()
    edited = [*data[:-2], (data[-2][0], "Someone", "1", "C"), data[-1]]
    a, b = (spark.createDataFrame(d, SCHEMA) for d in (data, edited))
    for hash_of in (set_hash, set_digest):
        changed = hash_of(a, ["group_id"]).exceptAll(hash_of(b, ["group_id"]))
        assert [r["group_id"] for r in changed.collect()] == [data[-2][0]]


def test_duplicates_count(spark):
    one = spark.createDataFrame([("g", "Ann", "1", "C")], SCHEMA)
    two = one.union(one)
    for hash_of in (set_hash, set_digest):
        assert hash_of(one, ["group_id"]).first()[1] != hash_of(two, ["group_id"]).first()[1]


def test_digest_distinguishes_what_the_listed_hash_does(spark):
    df = spark.createDataFrame(sample(), SCHEMA)
    listed, digest = set_hash(df, ["group_id"]), set_digest(df, ["group_id"])
    n = listed.select("set_hash").distinct().count()
    assert digest.select("set_hash").distinct().count() == n


def test_batches_of_a_few_rows_give_the_same_hashes(spark):
    data = sample()
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "3")
    try:
        got = set_hash(spark.createDataFrame(data, SCHEMA), ["group_id"]).collect()
    finally:
        spark.conf.set(key, before)
    assert {r[0]: (r[1], r[2]) for r in got} == brute_force(data)


def test_keys_of_any_kind_over_borders_of_batches(spark):
    """NULL keys and times; a snapshot that ends with a batch, and ones that go on over several."""
    day = [datetime.datetime(2024, 1, d) for d in (1, 2)]
    data = [(g, d, f"m{i}", "1", "C") for g, n in (("A", 3), (None, 7), ("B", 1)) for d in (*day, None) for i in range(n)]
    frame = spark.createDataFrame(data, "g STRING, d TIMESTAMP_NTZ, full_name STRING, number STRING, position STRING")
    want = defaultdict(list)
    for g, d, name, *_ in data:
        want[g, d].append(f"{name}|1|C")
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "3")
    try:
        got = set_hash(frame, ["g", "d"]).collect()
    finally:
        spark.conf.set(key, before)
    assert {(r[0], r[1]): (r[2], r[3]) for r in got} == {
        k: (hashlib.md5("||".join(sorted(v)).encode()).hexdigest(), len(v)) for k, v in want.items()
    } and len(got) == len(want)


def test_a_blank_row_never_changes_the_hash(spark):
    data = sample()
    blank = [(f"g{g}", name, "9", "D") for g in range(12) for name in ("", None, " ")]
    a, b = (spark.createDataFrame(d, SCHEMA) for d in (data, data + blank))
    for hash_of in (set_hash, set_digest):
        assert same(
            hash_of(a, ["group_id"]).select("group_id", "set_hash"),
            hash_of(b, ["group_id"]).select("group_id", "set_hash"),
        )


def test_with_set_hash_keeps_null_keys(spark):
    df = spark.createDataFrame([(None, "Ann", "1", "C"), ("g", "Bo", "2", "D")], SCHEMA)
    hashed = with_set_hash(df, set_hash(df, ["group_id"]), ["group_id"])
    assert hashed.where(F.col("set_hash").isNull()).isEmpty() and hashed.count() == 2


def test_drop_unnamed(spark):
    df = spark.createDataFrame(sample(), SCHEMA)
    left = drop_unnamed(df, "full_name")
    assert len(rows(left)) == sum(1 for r in sample() if (r[1] or "").strip())
