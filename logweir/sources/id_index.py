"""Stored event ids in buckets, so that large loads find known events without
shuffling the stored side.

The index is a bucketed Parquet table beside the events. ``indexed_batches`` names the
batches it covers, and is appended to after their ids are written; ids of a broken
load stay in the buckets but their batch is never named as committed. Batches that are
not covered yet, those of small loads, are few and are read from the events; the next
large load or a compaction covers them. A compaction starts a new generation.

A small load writes its new ids into one file of its own, ``batch_ids``, which the next
small loads read in place of the batch's events, that have a file for each day. A stream
has a batch for each micro-batch, and compares every one with those before it.
"""

from __future__ import annotations

import hashlib
import uuid
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from logweir.plans.shared import escaped, within_bound
from logweir.schemas import EVENT_IDS, INDEXED_BATCHES, ONLY_IDS
from logweir.sources.lake import (
    committed_batches,
    ever_committed,
    read_events,
    read_table,
    replaced_batches,
)
from logweir.sources.rawfiles import read_or_none

# Of a new index; an existing one keeps its number until it is rebuilt.
BUCKETS = 64

# One folder for each small batch, with its ids.
KEPT_FOLDER = "batch_ids"

# A table's location has no escapes: without this option Spark takes it for a pattern.
LITERAL_PATH = "OPTIONS ('__globPaths__' = 'false')"


def _newest(spark: SparkSession, lake_dir: str) -> Row | None:
    named = read_table(spark, f"{lake_dir}/indexed_batches", INDEXED_BATCHES)
    return named.orderBy(F.desc("generation")).select("generation", "buckets").first()


def _covered(spark: SparkSession, lake_dir: str, generation: str) -> DataFrame:
    named = read_table(spark, f"{lake_dir}/indexed_batches", INDEXED_BATCHES)
    return named.filter(F.col("generation") == generation).select("batch_id").distinct()


def _declared(spark: SparkSession, lake_dir: str, index: Row) -> str:
    """The catalog's name for the buckets, which lie in the lake itself."""
    path = f"{lake_dir}/event_ids/{index.generation}"
    name = f"logweir_ids_{hashlib.sha256(path.encode()).hexdigest()[:24]}"
    if not spark.catalog.tableExists(name):
        location = path.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE {name} ({EVENT_IDS}) USING parquet {LITERAL_PATH} "
            f"CLUSTERED BY (event_id) SORTED BY (event_id) INTO {index.buckets} BUCKETS "
            f"LOCATION '{location}'"
        )
    return name


def _write(spark: SparkSession, lake_dir: str, index: Row, ids: DataFrame, batches: DataFrame) -> None:
    # One file for each bucket.
    dealt = ids.select("event_id", "batch_id").repartition(index.buckets, "event_id")
    name = _declared(spark, lake_dir, index)
    (
        dealt.write.mode("append")
        .format("parquet")
        .bucketBy(index.buckets, "event_id")
        .sortBy("event_id")
        .saveAsTable(name)
    )
    spark.catalog.refreshTable(name)
    named = batches.select(
        F.lit(index.generation).alias("generation"),
        F.lit(index.buckets).alias("buckets"),
        "batch_id",
    )
    named.repartition(1).write.mode("append").parquet(f"{lake_dir}/indexed_batches")


def _new_generation(moment: datetime, buckets: int | None) -> Row:
    name = f"{moment:%Y%m%d%H%M%S%f}_{uuid.uuid4().hex[:8]}"
    return Row(generation=name, buckets=buckets or BUCKETS)


def cover(
    spark: SparkSession,
    lake_dir: str,
    fresh: DataFrame,
    batch_id: str,
    moment: datetime,
    buckets: int | None = None,
) -> None:
    """Add a batch that is about to be committed, and all committed ones not covered."""
    index = _newest(spark, lake_dir) or _new_generation(moment, buckets)
    missing = committed_batches(spark, lake_dir).join(
        _covered(spark, lake_dir, index.generation), "batch_id", "left_anti"
    )
    older = read_events(spark, lake_dir).join(F.broadcast(missing), "batch_id", "left_semi")
    own = F.lit(batch_id).alias("batch_id")
    ids = older.select("event_id", "batch_id").union(fresh.select("event_id", own))
    _write(spark, lake_dir, index, ids, missing.union(spark.range(1).select(own)))


def rebuild(spark: SparkSession, lake_dir: str, moment: datetime, buckets: int | None = None) -> None:
    """A new generation that covers all committed batches."""
    ids = read_events(spark, lake_dir)
    _write(
        spark, lake_dir, _new_generation(moment, buckets), ids, committed_batches(spark, lake_dir)
    )


def drop_indexed(spark: SparkSession, lake_dir: str, new: DataFrame) -> DataFrame:
    """Rows of ``new``, unique by ``event_id``, whose event is not stored.

    The rows of ``new`` are dealt like the buckets, which then are read in place.
    """
    index = _newest(spark, lake_dir)
    if index is None:
        return new.join(read_events(spark, lake_dir).select("event_id"), "event_id", "left_anti")
    covered = _covered(spark, lake_dir, index.generation)
    valid = covered.join(ever_committed(spark, lake_dir), "batch_id", "left_semi")
    known = spark.table(_declared(spark, lake_dir, index)).join(
        within_bound(valid, valid.count()), "batch_id", "left_semi"
    )
    rest = committed_batches(spark, lake_dir).join(covered, "batch_id", "left_anti")
    uncovered = read_events(spark, lake_dir).join(F.broadcast(rest), "batch_id", "left_semi")
    return (
        new.repartition(index.buckets, "event_id")
        .join(known.select("event_id"), "event_id", "left_anti")
        .join(uncovered.select("event_id"), "event_id", "left_anti")
    )


def keep(fresh: DataFrame, lake_dir: str, batch_id: str) -> None:
    """Write the ids of a small batch that is about to be committed."""
    ids = fresh.select("event_id").coalesce(1).sortWithinPartitions("event_id")
    ids.write.parquet(f"{lake_dir}/{KEPT_FOLDER}/batch_id={batch_id}")


def _kept(spark: SparkSession, lake_dir: str) -> set[str]:
    """Batches with a file of ids, committed or not."""
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{escaped(lake_dir)}/{KEPT_FOLDER}/batch_id=*")
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place)
    return {status.getPath().getName().partition("=")[2] for status in found or []}


def known_ids(spark: SparkSession, lake_dir: str) -> DataFrame:
    """``event_id`` of the stored events, for a small load.

    From the files of ids where a batch has one, a replaced batch too, since its events
    go on in another; else from the batch's events. One name per batch passes the
    driver; the folders of other batches are not listed.
    """
    kept = _kept(spark, lake_dir)
    if not kept:
        return read_events(spark, lake_dir).select("event_id")
    ever = {row.batch_id for row in ever_committed(spark, lake_dir).collect()}
    gone = {row.batch_id for row in replaced_batches(spark, lake_dir).collect()}
    tables = [
        _ids_in(spark, f"{lake_dir}/{KEPT_FOLDER}", ever & kept, kept),
        _ids_in(spark, f"{lake_dir}/events", ever - gone - kept),
    ]
    found = [table for table in tables if table is not None]
    return reduce(DataFrame.union, found) if found else spark.createDataFrame([], ONLY_IDS)


def _ids_in(
    spark: SparkSession, folder: str, batches: set[str], present: set[str] | None = None
) -> DataFrame | None:
    """Ids below the ``batches``' folders; all those ``present`` need not be named."""
    if not batches:
        return None
    names = "*" if batches == present else f"{{{','.join(sorted(batches))}}}"
    pattern = f"{escaped(folder)}/batch_id={names}"
    found = read_or_none(spark.read.schema(ONLY_IDS).parquet, pattern)
    return None if found is None else found.select("event_id")
