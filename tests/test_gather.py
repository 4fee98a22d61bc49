"""Parts of a snapshot gathered in a stream."""

import time

from pyspark.sql import functions as F

from snaphist.sources.documents import stream_documents
from snaphist.streaming.gather import gather_parts
from tests.test_ingest import document, land


def test_parts_of_a_snapshot_are_passed_on_together(spark, tmp_path):
    landing, checkpoint, out = tmp_path / "landing", str(tmp_path / "cp"), str(tmp_path / "out")
    provider = "spark.sql.streaming.stateStore.providerClass"
    spark.conf.set(provider, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")

    def stream():
        def write(batch, number):
            batch.withColumn("batch", F.lit(number)).write.mode("append").parquet(out)

        docs = stream_documents(spark, str(landing), files_per_batch=1)
        gathered = gather_parts(docs, "6 seconds")
        query = gathered.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        query.trigger(availableNow=True).start().awaitTermination()

    try:
        land(landing, 1, AAA=document("Ann"))
        folder = landing / "season=20252026" / "group=AAA" / "run=20240101T000000"
        (folder / "more.json").write_text(document("Bo"))
        stream()
        assert spark.read.parquet(out).count() == 0
        time.sleep(6)
        land(landing, 2, AAA=document("Cy"))
        stream()
        land(landing, 3, AAA=document("Di"))
        stream()
    finally:
        spark.conf.unset(provider)
    rows = spark.read.parquet(out).where("day(run_ts) = 1").collect()
    assert len(rows) == 2 and len({r["batch"] for r in rows}) == 1
    assert {r["payload"] for r in rows} == {document("Ann"), document("Bo")}
    assert all(r["group_id"] == "AAA" and r["season"] == "2025" and r["landed_at"] for r in rows)
