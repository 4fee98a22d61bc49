"""Where intermediate tables go."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# An input smaller than this per core is dealt out before costly work on its rows.
SPREAD_BYTES_PER_CORE = 16 << 20


def _is_local(spark: SparkSession) -> bool:
    """Whether driver and executors are one process; ``local-cluster`` is not."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A folder given by ``setCheckpointDir`` goes before the setting. Only a local session may fall
    back to a temporary folder, which goes when Python ends: on a cluster that folder would
    exist on one machine only, so there the setting is required.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    given = spark.sparkContext.getCheckpointDir()
    # The setting itself leads to a folder below it.
    if named and (not given or named.split(":", 1)[-1].rstrip("/") in given):
        return named.rstrip("/")
    if given:
        return given.rstrip("/")
    if not _is_local(spark):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    base = tempfile.mkdtemp(prefix="snaphist-")
    atexit.register(shutil.rmtree, base, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(base)
    return base


def _scratch_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/snaphist/{spark.sparkContext.applicationId}"


def hadoop_path(spark: SparkSession, path: str):
    """A path and its file system, wherever Spark's paths lead."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def new_dir(spark: SparkSession, name: str) -> str:
    """A folder of its own below the shared one, removed when the application ends."""
    scratch = _scratch_dir(spark)
    where, files = hadoop_path(spark, scratch)
    files.mkdirs(where)
    files.deleteOnExit(where)
    return f"{scratch}/{name}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder, if it exists, wherever Spark's paths lead."""
    where, files = hadoop_path(spark, path)
    files.delete(where, True)


def remove_scratch(spark: SparkSession) -> None:
    """Remove all intermediate tables of the application now; no result may still read them."""
    remove_folder(spark, _scratch_dir(spark))


def remove_table(df: DataFrame) -> None:
    """Remove a table that ``materialize`` made and that nothing reads any more."""
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        remove_folder(df.sparkSession, folder)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back, which fixes its rows and cuts its lineage.

    Columnar files let later passes read only the columns they need, and a lost
    executor costs a re-read instead of a recomputation.
    """
    spark = df.sparkSession
    path = new_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows of a small input to all cores.

    Meant for costly per-row work, such as parsing, on a few files. The size is the planner's
    estimate, which takes no job; inputs of ordinary size are split as they are read.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    small = int(str(size)) < cores * SPREAD_BYTES_PER_CORE
    return df.repartition(cores) if small else df
