"""Gathering the parts of a snapshot in a stream before it is decided.

A processor keeps the documents of each (group, season, run time) until no more have arrived for a while and then
passes them on together. What arrives later still is assembled with the stored snapshot by the run that brings it, so the
result does not depend on the time waited; waiting spares storing a snapshot once per part.

The event time is the time of the batch in which a document arrives. The watermark then never passes a
document, so none is dropped as late, whatever its landing time.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

KEYS = ["group_id", "season", "run_ts"]
_DOCUMENT = "payload string, problem string, landed_at string"
_OUT = "group_id string, season string, run_ts timestamp_ntz, payload string, problem string, landed_at string"


class GatherParts(StatefulProcessor):
    """Documents of one snapshot, passed on when the watermark is ``wait_ms`` beyond the arrival of the last."""

    def __init__(self, wait_ms: int):
        self.wait_ms = wait_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.parts = handle.getListState("parts", _DOCUMENT)
        self.due = handle.getValueState("due", "at long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        at = None
        for batch in rows:
            for payload, problem, landed in zip(batch["payload"], batch["problem"], batch["landed_at"]):
                self.parts.appendValue((_text(payload), _text(problem), _text(landed)))
            at = int(batch["arrived_ms"].max()) + self.wait_ms
        if at is not None:
            known = self.due.get()
            if known is not None:
                self.handle.deleteTimer(known[0])
            self.due.update((at,))
            self.handle.registerTimer(at)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        parts = list(self.parts.get())
        self.parts.clear()
        self.due.clear()
        if parts:
            group, season, run_ts = key
            yield pd.DataFrame(
                {
                    "group_id": [group] * len(parts),
                    "season": [season] * len(parts),
                    "run_ts": pd.to_datetime([run_ts] * len(parts)),
                    "payload": [p[0] for p in parts],
                    "problem": [p[1] for p in parts],
                    "landed_at": [p[2] for p in parts],
                }
            )

    def close(self) -> None:
        pass


def _text(value):
    return None if value is None or value != value else str(value)


def gather_parts(docs: DataFrame, wait: str = "10 minutes") -> DataFrame:
    """``docs`` (see ``sources.documents.stream_documents``) with the parts of a snapshot together.

    ``wait`` is how long after the last part of a snapshot another one may follow; the documents are passed on by the
    first batch after it. State holds the documents that wait; it needs the RocksDB provider, which keeps them on disk.
    """
    wait_ms = int(pd.Timedelta(wait).total_seconds() * 1000)
    arrived = F.current_timestamp()
    timed = docs.select(
        *KEYS, "payload", "problem", F.col("landed_at").cast("string").alias("landed_at"),
        F.unix_millis(arrived).alias("arrived_ms"), arrived.alias("arrived"),
    ).withWatermark("arrived", "0 seconds")
    gathered = timed.groupBy(*KEYS).transformWithStateInPandas(
        statefulProcessor=GatherParts(wait_ms), outputStructType=_OUT, outputMode="Append", timeMode="EventTime"
    )
    return gathered.withColumn("landed_at", F.col("landed_at").cast("timestamp_ntz"))
