"""Incremental ingestion: the run of ``plans.ingest`` for every batch of landed documents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from snaphist.functions.codes import DEFAULT_SOURCE
from snaphist.plans.ingest import ingest
from snaphist.streaming.gather import gather_parts


def ingest_stream(
    docs: DataFrame,
    root: str,
    checkpoint: str,
    *,
    source: str = DEFAULT_SOURCE,
    tracked: DataFrame | None = None,
    force: bool = False,
    existing: Callable[[SparkSession], DataFrame] | None = None,
    keep_raw: bool = False,
    hash_form: str | None = None,
    gather: str | None = None,
    available_now: bool = True,
    name: str = "ingest",
) -> StreamingQuery:
    """Start ingesting a stream of documents (see ``sources.documents.stream_documents``).

    The run id follows from the batch number and the run time from the landing times, so a
    batch that Spark repeats after a failure replays its run instead of adding to it. State
    lives in the versioned state table: a snapshot older than its group's state is logged as
    late, stored, and replaces nothing. ``existing`` gives the groups with stored snapshots anew for each
    batch; the other options are those of a run. With ``gather``, such as "10 minutes", the documents of a
    snapshot wait for further parts that long (see ``gather_parts``); the result is the same without.
    """

    def run_batch(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        ingest(
            batch,
            root,
            run_id=f"{name}-{batch_id:09d}",
            source=source,
            tracked=tracked,
            existing=None if existing is None else existing(batch.sparkSession),
            force=force,
            keep_raw=keep_raw,
            hash_form=hash_form,
        )

    if gather is not None:
        docs = gather_parts(docs, gather)
    writer = docs.writeStream.foreachBatch(run_batch).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.queryName(name).start()
