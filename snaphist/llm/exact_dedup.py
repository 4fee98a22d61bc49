"""Exact duplicates by a stateful stream over digests.

Each text is read once for its digest and locator, which are written as a table. A stream over
that table keeps one entry per digest, for ever, in a RocksDB state store: the stable identifier of
the row that stays, the locator of its content and the number of rows. A digest that is met again is
a hit: the full bytes of hits are then compared with the located content, and rows whose bytes differ
in spite of equal digests form groups of their own. All of it is DataFrame code.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snaphist.llm.store import ascii_lower, same, small, table
from snaphist.session import new_dir

_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# All stores of an executor share so much native memory. They stay open for a while after the stream has ended, and each
# would otherwise have buffers and a cache of its own.
_STORES_MB = "128"


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def digests(
    docs: DataFrame,
    normalise: Callable[[Column], Column] = ascii_lower,
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """(doc_id, digest, locator) of each row; the locator is the file that holds the row."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        digest(normalise(F.col("text"))).alias("digest"),
        F.input_file_name().alias("locator"),
    )


def stream_state(found: DataFrame, max_files: int) -> DataFrame:
    """Run the digest table through the stream; (digest, keep_id, keep_locator, n) of its state.

    ``found`` is a table of files, read in micro-batches of ``max_files``. The state lives in the
    checkpoint, so a run that is interrupted goes on where it stopped.
    """
    spark = found.sparkSession
    checkpoint = new_dir(spark, "dedup-state")
    session = spark.newSession()
    session.conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKSDB)
    # Many small stores: no room is set aside for the logs of each.
    session.conf.set("spark.sql.streaming.stateStore.rocksdb.allowFAllocate", "false")
    session.conf.set("spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage", "true")
    session.conf.set("spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB", _STORES_MB)
    session.conf.set(
        "spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions")
    )
    folder = found.inputFiles()[0].rsplit("/", 1)[0]
    stream = (
        session.readStream.schema(found.schema)
        .option("maxFilesPerTrigger", max_files)
        .parquet(folder)
        .groupBy("digest")
        .agg(F.max(F.struct("doc_id", "locator")).alias("keeper"), F.count("*").alias("n"))
    )
    query = (
        stream.writeStream.format("noop")
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    state = spark.read.format("statestore").load(checkpoint)
    keeper, n = (F.col("value")[f.name] for f in state.schema["value"].dataType.fields)
    return state.select(
        F.col("key.digest").alias("digest"),
        keeper.doc_id.alias("keep_id"),
        keeper.locator.alias("keep_locator"),
        n.alias("n"),
    )


def deduplicate(
    docs: DataFrame,
    normalise: Callable[[Column], Column] = ascii_lower,
    digest: Callable[[Column], Column] = sha256,
    max_files: int = 1000,
) -> DataFrame:
    """One row per row of ``docs``: (doc_id, digest, keep_id, group_size, kept).

    Texts are equal when their normalised bytes are; null counts as empty. The row with the
    largest doc_id stays, a null doc_id is below all others. Of rows that agree in doc_id and text
    one stays. Other columns, whatever their names, are ignored. An empty table gives no rows.
    """
    found = table(digests(docs, normalise, digest), "digests")
    if not found.inputFiles():
        return found.select(
            "doc_id", "digest", F.col("doc_id").alias("keep_id"),
            F.lit(0).cast("long").alias("group_size"), F.lit(True).alias("kept"),
        )
    state = table(stream_state(found, max_files), "dedup-groups")
    groups = state.select(F.col("digest").alias("_digest"), "keep_id", F.col("n"))
    members = found.join(groups, found["digest"] == groups["_digest"]).drop("_digest")
    odd = _differing(docs, members, normalise, digest)
    if odd is not None:
        members = _regroup(members, odd)
    order = Window.partitionBy("digest", "keep_id", "doc_id").orderBy("locator")
    return members.select(
        "doc_id",
        "digest",
        "keep_id",
        F.col("n").alias("group_size"),
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.row_number().over(order) == 1)).alias(
            "kept"
        ),
    )


def _differing(docs, members, normalise, digest) -> DataFrame | None:
    """Rows of groups whose bytes are not all equal: (doc_id, digest, text) of each such group.

    Only texts of groups with hits are compared: each with the content located for its group.
    """
    hits = table(
        members.where("n > 1").select("doc_id", F.col("digest").alias("_digest"), "keep_id", "locator"),
        "dedup-hits",
    )
    wanted = small(hits.groupBy(F.col("doc_id").alias("_id"), "_digest", "keep_id").agg(F.lit(1).alias("_")))
    text = normalise(F.col("text"))
    rows = same(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("_text")).withColumn(
            "digest", digest(F.col("_text"))
        ),
        wanted,
        {"doc_id": "_id", "digest": "_digest"},
        "inner",
    ).select("doc_id", "digest", "keep_id", "_text")
    keepers = (
        rows.where(F.col("doc_id").eqNullSafe(F.col("keep_id")))
        .groupBy(F.col("digest").alias("_of"))
        .agg(F.max("_text").alias("_kept_text"))
    )
    bad = table(
        rows.join(keepers, rows["digest"] == keepers["_of"])
        .where(F.col("_text") != F.col("_kept_text"))
        .select(F.col("digest").alias("_bad"))
        .distinct(),
        "dedup-collisions",
    )
    if bad.isEmpty():
        return None
    texts = rows.join(small(bad), F.col("digest") == F.col("_bad"))
    return table(texts.select("doc_id", "digest", "_text"), "dedup-differing")


def _regroup(members: DataFrame, odd: DataFrame) -> DataFrame:
    """Groups whose digest stands for several texts are grouped by the texts themselves."""
    groups = odd.groupBy("digest", "_text").agg(
        F.max("doc_id").alias("_keep"), F.count("*").alias("_n")
    )
    left, right = odd.alias("a"), groups.alias("b")
    own = left.join(
        right, (F.col("a.digest") == F.col("b.digest")) & (F.col("a._text") == F.col("b._text"))
    ).select(
        "a.doc_id", "a.digest", F.lit("").alias("locator"),
        F.col("b._keep").alias("keep_id"), F.col("b._n").alias("n"),
    )
    rest = members.join(odd.select(F.col("digest").alias("_d")).distinct(), F.col("digest") == F.col("_d"), "left_anti")
    return rest.select(*own.columns).unionByName(own)


def keep(docs: DataFrame, decisions: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    decisions = table(decisions, "dedup-decisions")
    keys = decisions.groupBy(F.col("doc_id").alias("_id"), F.col("digest").alias("_d")).agg(
        F.max("kept").alias("_kept"), F.count("*").alias("_n")
    )
    keys = table(keys.where("not _kept or _n > 1"), "dedup-dropped")
    rows = docs.withColumn("_digest", sha256(ascii_lower(F.col("text"))))
    on = {"doc_id": "_id", "_digest": "_d"}
    once = same(rows, small(keys), on, "left_anti")
    repeated = keys.where("_kept")
    if not repeated.isEmpty():
        again = same(rows, repeated, on, "left_semi").dropDuplicates(["doc_id", "_digest"])
        once = once.unionByName(again)
    return once.select(*docs.columns)
