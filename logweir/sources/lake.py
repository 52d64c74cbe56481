"""The stored tables in Parquet: ``events``, ``loaded_files``, ``rejected_files``.

A load writes its events under a batch id of its own and makes them visible by
one manifest file that names the batch. Whatever a broken load left behind is
never read. A compaction writes many batches as one and replaces their ids by one
file of ``compactions``. One writer at a time is assumed.
"""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logweir.functions.time import naive_utc, ntz, positive
from logweir.operators.loading import latest_by
from logweir.plans.shared import escaped, stored
from logweir.schemas import (
    COMPACTIONS,
    EVENTS,
    EVENTS_LAYOUT,
    LOADED_FILES,
    REJECTED_FILES,
)
from logweir.sources.rawfiles import read_or_none


# Let a search for one repository or event skip row groups that lack it; sized to fit.
BLOOM_FILTERS = {
    "parquet.bloom.filter.enabled#repo_name": "true",
    "parquet.bloom.filter.enabled#event_id": "true",
    "parquet.bloom.filter.adaptive.enabled": "true",
}

# Each file of it is one swap.
COMPACTION_FOLDER = "compactions"


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The Parquet files of a folder, whatever its name; no rows where it is absent."""
    found = read_or_none(spark.read.schema(schema).parquet, escaped(path))
    return spark.createDataFrame([], schema) if found is None else found


def read_manifest(spark: SparkSession, lake_dir: str) -> DataFrame:
    """One row per loaded file, the latest if a name was recorded again."""
    rows = read_table(spark, f"{lake_dir}/loaded_files", LOADED_FILES)
    return latest_by(rows, "file_path", "loaded_at")


def read_events(spark: SparkSession, lake_dir: str) -> DataFrame:
    """Committed events, with the partition columns behind the table's own.

    A semi join on the committed batch ids, which Spark turns into partition
    pruning at run time; nothing is collected. The ids are broadcast: joined by hash,
    all events of a batch would go to one task. They are fewer than the batches'
    folders, which the reader's listing holds in any case.
    """
    events = read_table(spark, f"{lake_dir}/events", EVENTS_LAYOUT)
    columns = EVENTS_LAYOUT.fieldNames()
    committed = committed_batches(spark, lake_dir)
    return events.join(F.broadcast(committed), "batch_id", "left_semi").select(*columns)


def ever_committed(spark: SparkSession, lake_dir: str) -> DataFrame:
    """Ids of all batches a load or a compaction has committed, replaced ones too."""
    loaded = read_table(spark, f"{lake_dir}/loaded_files", LOADED_FILES)
    merged = read_table(spark, f"{lake_dir}/{COMPACTION_FOLDER}", COMPACTIONS)
    return loaded.select("batch_id").union(merged.select("batch_id")).distinct()


def committed_batches(spark: SparkSession, lake_dir: str) -> DataFrame:
    """Ids of the batches that make up the table now."""
    replaced = replaced_batches(spark, lake_dir)
    return ever_committed(spark, lake_dir).join(replaced, "batch_id", "left_anti")


def replaced_batches(spark: SparkSession, lake_dir: str) -> DataFrame:
    """Ids of the batches whose events a compaction has written anew."""
    merged = read_table(spark, f"{lake_dir}/{COMPACTION_FOLDER}", COMPACTIONS)
    return merged.select(F.col("replaced_id").alias("batch_id"))


def read_rejected(spark: SparkSession, lake_dir: str) -> DataFrame:
    """Every refusal of a file: ``file_path, reason, rejected_at``."""
    return read_table(spark, f"{lake_dir}/rejected_files", REJECTED_FILES)


def record_rejected(files: DataFrame, lake_dir: str) -> None:
    files.write.mode("append").parquet(f"{lake_dir}/rejected_files")


def write_events(events: DataFrame, lake_dir: str, batch_id: str) -> int:
    """Write one batch, by day and sorted by time; return its row count.

    Rebalancing packs small results and splits a day that holds most rows.
    """
    path = f"{lake_dir}/events/batch_id={batch_id}"
    written = Observation()
    dated = events.select(
        *EVENTS.fieldNames(), F.col("created_at").cast("date").alias("created_date")
    )
    (
        dated.hint("rebalance", "created_date")
        .sortWithinPartitions("created_date", "created_at")
        .observe(written, F.count(F.lit(1)).alias("rows"))
        .write.partitionBy("created_date")
        .options(**BLOOM_FILTERS)
        .parquet(path)
    )
    return written.get["rows"]


def commit_files(files: DataFrame, lake_dir: str) -> None:
    """Append manifest rows as one file, which is what commits a batch.

    A batch has a bounded number of files. They are hashed where they lie; only
    the finished rows are brought together.
    """
    (
        files.select(*LOADED_FILES.fieldNames())
        .repartition(1)
        .write.mode("append")
        .parquet(f"{lake_dir}/loaded_files")
    )


def compact_events(
    spark: SparkSession,
    lake_dir: str,
    *,
    max_rows: int | None = None,
    load_ts: datetime | str | None = None,
) -> int:
    """Write the committed batches anew as one, by day; return how many it replaced.

    With ``max_rows`` only batches of at most so many events. The rows stay as they
    are, but for their batch id. Readers see the old batches until one file is
    appended, and the new one from then on; a crash before leaves a batch that nobody
    reads. Old files stay until ``remove_replaced``.
    """
    moment = naive_utc(load_ts)
    events = read_events(spark, lake_dir)
    sizes = events.groupBy("batch_id").agg(F.count(F.lit(1)).alias("rows"))
    if max_rows is not None:
        sizes = sizes.filter(F.col("rows") <= positive("max_rows", max_rows))
    # One row for each batch; fixed, since the swap must name what was rewritten.
    old = stored(sizes)
    batches, rows = old.agg(F.count(F.lit(1)), F.sum("rows")).first()
    if batches < 2:
        return 0
    batch_id = f"{moment:%Y%m%d_%H%M%S}_{uuid.uuid4().hex[:12]}"
    merged = events.join(F.broadcast(old.select("batch_id")), "batch_id", "left_semi")
    if write_events(merged, lake_dir, batch_id) != rows:
        raise RuntimeError("the events changed during the compaction")
    (
        old.select(
            F.lit(batch_id).alias("batch_id"),
            F.col("batch_id").alias("replaced_id"),
            ntz(moment).alias("compacted_at"),
        )
        .repartition(1)
        .write.mode("append")
        .parquet(f"{lake_dir}/{COMPACTION_FOLDER}")
    )
    return batches


def remove_replaced(spark: SparkSession, lake_dir: str, before: datetime | str) -> int:
    """Delete batches replaced before a moment that no reader is still behind of."""
    merged = read_table(spark, f"{lake_dir}/{COMPACTION_FOLDER}", COMPACTIONS)
    old = merged.filter(F.col("compacted_at") < ntz(before)).select("replaced_id")
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    removed = 0
    for row in old.toLocalIterator():
        path = jvm.org.apache.hadoop.fs.Path(f"{lake_dir}/events/batch_id={row.replaced_id}")
        removed += bool(path.getFileSystem(conf).delete(path, True))
    return removed
