"""Tables that all executors see, and size checks for broadcasts."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Rows a table may have to be broadcast by hint.
MAX_BROADCAST_ROWS = 200_000

# The most tasks that list files.
LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
LISTING_TASKS_PER_CORE = 4

_RUNS: dict[str, list[str]] = {}


def escaped(path: str) -> str:
    """A path as Spark's readers take it: they expand glob patterns."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session, whose executors are threads of the driver, may do
    without it; on a cluster a folder of one machine would lose data.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    known = configured or context.getCheckpointDir()
    if known is None:
        if not context.master.startswith("local") or "cluster" in context.master:
            raise RuntimeError(
                "set spark.checkpoint.dir to a folder that all executors share"
            )
        known = tempfile.mkdtemp(prefix="logweir-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(known)
    return known


def run_folder(spark: SparkSession) -> str:
    """A new folder for one run's tables; ``clear_runs`` removes it."""
    folder = f"{shared_dir(spark)}/run-{uuid.uuid4().hex}"
    _RUNS.setdefault(spark.sparkContext.applicationId, []).append(folder)
    return folder


def clear_runs(spark: SparkSession) -> int:
    """Remove this session's run folders, once their results are not read again."""
    folders = _RUNS.pop(spark.sparkContext.applicationId, [])
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for folder in folders:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)
    return len(folders)


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back.

    Cuts the lineage, and survives the loss of executors.
    """
    path = run_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(escaped(path))


def stored_and_counted(df: DataFrame) -> tuple[DataFrame, int]:
    """``stored``, and the number of rows, which is counted while writing."""
    rows, found = stored_and_observed(df, F.count(F.lit(1)).alias("rows"))
    return rows, found["rows"]


def stored_and_observed(df: DataFrame, *measures: Column) -> tuple[DataFrame, dict]:
    """``stored``, and named aggregates of its rows, which are taken while writing."""
    path = run_folder(df.sparkSession)
    seen = Observation()
    df.observe(seen, *measures).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(escaped(path)), seen.get


def bounded_listing(spark: SparkSession) -> None:
    """Let Spark list many files in a few tasks per core, not in a task per file.

    A stream lists every micro-batch with the settings of the session it was started
    in, so they can't be put back. A lower setting is kept.
    """
    tasks = LISTING_TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    if int(spark.conf.get(LISTING_TASKS)) > tasks:
        spark.conf.set(LISTING_TASKS, str(tasks))


def cut(df: DataFrame) -> DataFrame:
    """A reliable checkpoint: the rows and their partitions are fixed."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def within_bound(df: DataFrame, rows: int) -> DataFrame:
    """``df`` marked for broadcast if its counted ``rows`` are few enough."""
    return F.broadcast(df) if rows <= MAX_BROADCAST_ROWS else df
