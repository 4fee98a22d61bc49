"""Snapshot documents: one nested JSON text per group, season and run, landed as files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader

from snaphist.functions.seasons import season_to_short
from snaphist.functions.times import in_utc

PATH_SEPARATOR = "/"


def _path_value(name: str) -> Column:
    """Value of a ``name=value`` folder in the file's path, NULL if there is none."""
    found = F.regexp_extract(F.col("_metadata.file_path"), f"/{name}=([^/]+)/", 1)
    decoded = F.try_url_decode(F.replace(found, F.lit("+"), F.lit("%2B")))
    return F.nullif(decoded, F.lit(""))


def _load(reader, path: str, one_per_file: bool) -> DataFrame:
    text = (
        reader.format("text")
        .option("wholetext", one_per_file)
        .option("recursiveFileLookup", True)
        .load(path)
    )
    stamp = F.regexp_replace("_run", r"^(\d{4})(\d\d)(\d\d)T(\d\d)(\d\d)(\d\d)$", "$1-$2-$3 $4:$5:$6")
    run_ts = F.when(F.col("_run").rlike(r"^\d{8}T\d{6}$"), stamp.try_cast("timestamp_ntz"))
    has_run = F.contains(F.col("_metadata.file_path"), F.lit("/run="))
    return text.select(
        _path_value("group").alias("group_id"),
        season_to_short(_path_value("season")).alias("season"),
        _path_value("run").alias("_run"),
        has_run.alias("_has_run"),
        F.col("value").alias("payload"),
        in_utc(F.col("_metadata.file_modification_time")).alias("landed_at"),
    ).select(
        "group_id",
        "season",
        run_ts.alias("run_ts"),
        "payload",
        "landed_at",
        F.when(F.col("group_id").isNull(), F.lit("no group in the path"))
        .when(F.col("_has_run") & run_ts.isNull(), F.lit("run folder cannot be read"))
        .alias("problem"),
    )


def read_documents(spark: SparkSession, path: str, one_per_file: bool = True) -> DataFrame:
    """Documents below ``path``, laid out as ``season=…/group=…[/run=yyyyMMddTHHmmss]/*``.

    Set ``one_per_file=False`` for files with one document per line, the better layout for
    many small documents. ``problem`` says what in a path cannot be read; such a document
    disturbs no other.
    """
    return _load(spark.read, path, one_per_file)


def stream_documents(
    spark: SparkSession, path: str, one_per_file: bool = True, files_per_batch: int | None = None
) -> DataFrame:
    """The same documents as a stream of newly landed files."""
    reader: DataStreamReader = spark.readStream
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return _load(reader, path, one_per_file)
