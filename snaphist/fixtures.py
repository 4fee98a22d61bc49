"""Views of the given tables in the shape of snapshot data.

Each adapter reads whole tables and derives every row from them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snaphist.functions.seasons import season_of


# Declared, so that opening a table does not need a job to read its footers.
SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_mktsegment STRING",
    "part": "p_partkey BIGINT, p_name STRING",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, props STRING",
    "pages": "page_id BIGINT, url STRING, html STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def week_of(ts: Column) -> Column:
    """Monday of the week, at midnight, whatever the session time zone."""
    return F.date_sub(F.next_day(ts, "Mon"), 7).cast("timestamp_ntz")


def day_of(ts: Column) -> Column:
    return ts.cast("date").cast("timestamp_ntz")


def _number() -> Column:
    return F.regexp_extract("props", "([0-9]+)", 1)


def group_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group = user, run = week, member = event type, number = latest reading of the week."""
    events = table(spark, sf_dir, "events")
    return (
        events.groupBy(
            F.col("user_id").cast("string").alias("group_id"),
            week_of(F.col("ts")).alias("run_ts"),
            F.col("event_type").alias("member"),
        )
        .agg(
            F.max_by(_number(), "ts").alias("number"),
            F.count("*").cast("bigint").alias("n_rows"),
        )
        .select(
            "group_id",
            season_of(F.col("run_ts")).alias("season"),
            "run_ts",
            "member",
            "number",
            F.upper(F.substring("member", 1, 1)).alias("position"),
            "n_rows",
        )
    )


def member_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Member = user, group = event type, one dated row per event."""
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.col("user_id").alias("member"),
        "ts",
        F.col("event_type").alias("group_id"),
        _number().alias("number"),
    )


def raw_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the raw table: member = user, group = event type, run = event time."""
    number = _number()
    codes = F.array(*[F.lit(c) for c in ("C", "LW", "RW", "F", "RW/C", "D", "G", "X")])
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("group_id"),
        season_of(F.col("ts")).alias("season"),
        F.date_format("ts", "yyyyMMdd").alias("run_id"),
        F.col("ts").alias("run_ts"),
        F.lit("events").alias("source"),
        F.col("user_id").cast("string").alias("member_id"),
        F.concat(F.lit("/member/"), F.col("user_id").cast("string")).alias("member_url"),
        number.alias("number"),
        F.concat(F.lit("User "), F.col("user_id").cast("string")).alias("full_name"),
        F.element_at(codes, F.col("event_id").cast("int") % 8 + 1).alias("position"),
        F.lit(None).cast("string").alias("age"),
        (F.col("event_id") % 3 + 70).cast("string").alias("height"),
        (F.col("event_id") % 2 + 180).cast("string").alias("weight"),
        F.when(F.col("user_id") % 2 == 0, "L").otherwise("R").alias("shoots_catches"),
        F.lit(None).cast("string").alias("experience"),
        F.lit("").alias("birth_date"),
        F.lit(None).cast("string").alias("summary"),
        F.lit(None).cast("string").alias("set_hash"),
    )


def messy_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with NULL and empty ids and NULL attributes; group = order year."""
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        key.alias("row_id"),
        F.year("o_orderdate").cast("string").alias("group_id"),
        season_of(F.col("o_orderdate")).alias("season"),
        F.when(key % 7 == 0, F.lit(None))
        .when(key % 11 == 0, F.lit(""))
        .otherwise(F.col("o_custkey").cast("string"))
        .alias("member_id"),
        F.col("o_orderpriority").alias("full_name"),
        F.when(key % 5 == 0, F.lit(None)).otherwise(F.col("o_orderstatus")).alias("position"),
        F.col("o_orderdate").alias("run_ts"),
        F.lpad(key.cast("string"), 20, "0").alias("run_id"),
    )


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw payloads of both kinds."""
    props = table(spark, sf_dir, "events").select(
        F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("row_id"),
        F.col("props").alias("payload"),
    )
    html = table(spark, sf_dir, "pages").select(
        F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("row_id"),
        F.col("html").alias("payload"),
    )
    return props.unionByName(html)


def order_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One nested document per order: one or two forwards, and a defenseman unless open.

    Forwards write the birth date as an object, defensemen as a scalar; absent keys and
    sections are left out of the JSON text.
    """
    key = F.col("o_orderkey").cast("string")
    customer = F.col("o_custkey")
    finished = F.col("o_orderstatus") == "F"
    forward = F.struct(
        customer.alias("id"),
        F.struct(F.lit(" Cust").alias("default")).alias("firstName"),
        F.struct(customer.cast("string").alias("default")).alias("lastName"),
        F.struct(F.date_format("o_orderdate", "yyyy-MM-dd").alias("default")).alias("birthDate"),
        (F.col("o_orderkey") % 100).alias("sweaterNumber"),
        F.lit("L").alias("positionCode"),
        F.lit(True).alias("rookie"),
    )
    unnumbered = F.struct(
        F.lit(None).cast("bigint").alias("id"),
        F.struct(F.lit("Spare").alias("default")).alias("firstName"),
        F.struct(key.alias("default")).alias("lastName"),
        F.struct(F.lit(None).cast("string").alias("default")).alias("birthDate"),
        F.lit(None).cast("bigint").alias("sweaterNumber"),
        F.lit("C").alias("positionCode"),
        F.lit(None).cast("boolean").alias("rookie"),
    )
    defenseman = F.struct(
        F.col("o_orderkey").alias("id"),
        F.struct(F.col("o_orderpriority").alias("default")).alias("firstName"),
        F.date_format("o_orderdate", "yyyy").alias("birthDate"),
        F.lit("D").alias("positionCode"),
        F.lit(70).alias("heightInInches"),
    )
    document = F.struct(
        F.when(finished, F.array(forward, unnumbered))
        .otherwise(F.array(forward))
        .alias("forwards"),
        F.when(F.col("o_orderstatus") != "O", F.array(defenseman)).alias("defensemen"),
    )
    return table(spark, sf_dir, "orders").select(
        key.alias("group_id"),
        season_of(F.col("o_orderdate")).alias("season"),
        F.to_json(document).alias("payload"),
    )


def snapshot_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group snapshots as documents. Each lists one member: a snapshot may have many documents."""
    member = F.struct(
        F.col("member").alias("id"),
        F.struct(F.col("member").alias("default")).alias("firstName"),
        F.col("position").alias("positionCode"),
    )
    return group_snapshots(spark, sf_dir).select(
        "group_id",
        "season",
        "run_ts",
        F.to_json(F.struct(F.array(member).alias("forwards"))).alias("payload"),
    )


def event_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group = event type, run = week; one document per event, so that a snapshot has many."""
    user = F.col("user_id").cast("string")
    member = F.struct(
        F.col("user_id").alias("id"),
        F.struct(F.lit("User").alias("default")).alias("firstName"),
        F.struct(user.alias("default")).alias("lastName"),
        _number().alias("sweaterNumber"),
    )
    run_ts = week_of(F.col("ts"))
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("group_id"),
        season_of(run_ts).alias("season"),
        run_ts.alias("run_ts"),
        F.to_json(F.struct(F.array(member).alias("goalies"))).alias("payload"),
    )


def names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of two tokens and of one."""
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("full_name")
    )
    customer = table(spark, sf_dir, "customer").select(
        (F.col("c_custkey") + 1_000_000_000_000).alias("id"), F.col("c_name").alias("full_name")
    )
    return part.unionByName(customer)


def order_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("d")
    )


def daily_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Member = user, run = day, group = the event type last seen on that day."""
    return (
        table(spark, sf_dir, "events")
        .groupBy(F.col("user_id").alias("member"), day_of(F.col("ts")).alias("run_ts"))
        .agg(F.max_by("event_type", "ts").alias("group_id"))
    )
