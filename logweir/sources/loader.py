"""The incremental, idempotent load of raw files into the events table."""

from __future__ import annotations

import logging
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime
from itertools import groupby

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from logweir.functions.time import naive_utc, ntz
from logweir.operators.loading import (
    PLACE,
    classify_files,
    drop_existing,
    failures,
    id_table,
    parse_lines,
    without_files,
)
from logweir.operators.nested import create_views
from logweir.plans.shared import (
    MAX_BROADCAST_ROWS,
    stored,
    stored_and_counted,
    stored_and_observed,
    within_bound,
)
from logweir.sources import id_index, landed
from logweir.sources.lake import (
    commit_files,
    read_events,
    read_manifest,
    read_rejected,
    record_rejected,
    write_events,
)
from logweir.sources.rawfiles import fingerprints, list_files, read_lines

logger = logging.getLogger(__name__)

INVALID = "not loaded, has invalid lines"
MODIFIED = "skipped, modified since it was loaded"

# What one commit takes in. Later files wait for the next commit of the call.
MAX_BATCH_FILES = 100_000
MAX_BATCH_BYTES = 10 << 40


@dataclass(frozen=True)
class LoadResult:
    scanned_files: int
    loaded_files: int
    skipped_files: int
    inserted_events: int
    duration_ms: int
    location: str


def load_events(
    spark: SparkSession,
    raw_dir: str,
    lake_dir: str,
    *,
    load_ts: datetime | str | None = None,
    verify_known: bool = False,
    views: bool = True,
    max_batch_files: int = MAX_BATCH_FILES,
    max_batch_bytes: int = MAX_BATCH_BYTES,
) -> LoadResult:
    """Load the files not loaded before; safe to repeat.

    A known file is skipped whether or not it changed. One whose size or time
    changed is hashed again and reported if its content differs;
    ``verify_known`` hashes every known file. Landed folders that were loaded whole
    are counted by the ledger and not listed again, unless ``verify_known`` is set.
    ``views`` registers the tables and the nested views in the session, as they are
    after this load.
    """
    started = time.perf_counter()
    moment = naive_utc(load_ts)
    folders = landed.look_up(spark, raw_dir, lake_dir, all_folders=verify_known)
    listing = list_files(spark, raw_dir, folders.to_list)
    seen = _compare_listing(listing, read_manifest(spark, lake_dir))
    known = F.col("known_size").isNotNull()
    counts = seen.agg(F.count(F.lit(1)), F.count_if(known)).first()
    scanned, skipped = (count + folders.files_loaded for count in counts)

    touched = (F.col("known_size") != F.col("file_size")) | (
        F.col("known_mtime") != F.col("file_mtime")
    )
    suspect = known & (F.lit(True) if verify_known else touched)

    loaded = inserted = 0
    listed = _by_name(seen.filter(suspect | ~known).withColumn("is_known", known))
    for is_known, files in groupby(listed, lambda file: file.is_known):
        for chunk in _chunks(files, max_batch_files, max_batch_bytes):
            if is_known:
                _report_modified(spark, chunk, lake_dir, moment)
                continue
            lines = read_lines(spark, [file.path for file in chunk])
            added_files, added_events = load_batch(lines, chunk, lake_dir, moment)
            loaded += added_files
            inserted += added_events
    landed.record(spark, listing, folders, lake_dir, moment)

    if views:
        create_views(read_events(spark, lake_dir))
        read_manifest(spark, lake_dir).createOrReplaceTempView("loaded_files")
    duration = int((time.perf_counter() - started) * 1000)
    return LoadResult(scanned, loaded, skipped, inserted, duration, lake_dir)


@dataclass(frozen=True)
class Staged:
    """Parsed lines in a written table: all, those that are ok, the ends of their ids."""

    rows: DataFrame
    total: int
    ok: int
    low: str | None
    high: str | None


def staged(parsed: DataFrame) -> Staged:
    """Write parsed lines, which fixes their places."""
    rows, seen = stored_and_observed(
        parsed,
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("status") == "ok").alias("ok"),
        F.min("event_id").alias("low"),
        F.max("event_id").alias("high"),
    )
    return Staged(rows, seen["total"], seen["ok"], seen["low"], seen["high"])


def load_batch(
    lines: DataFrame, files: list[Row], lake_dir: str, moment: datetime
) -> tuple[int, int]:
    """Load and commit the lines of ``files``; return files and events added."""
    return load_staged(staged(parse_lines(lines)), files, lake_dir, moment)


def load_staged(
    lines: Staged, files: list[Row], lake_dir: str, moment: datetime
) -> tuple[int, int]:
    """Load and commit lines that were parsed once; return files and events added.

    What is decided about them is decided on ids and places; whole lines are read again
    when they are written.
    """
    spark = lines.rows.sparkSession
    batch_id = f"{moment:%Y%m%d_%H%M%S}_{uuid.uuid4().hex[:12]}"
    loaded_at = ntz(moment).alias("loaded_at")
    # Narrow rows, hashed once. A file that was not read must not be committed.
    described, found = stored_and_counted(fingerprints(spark, files))
    if found != len(files):
        raise RuntimeError("some files could not be read back under their names")
    large = lines.ok > MAX_BROADCAST_ROWS
    known = (read_events if large else id_index.known_ids)(spark, lake_dir)
    if lines.low is not None:
        # Only these can be repeated. Ids mostly grow with time, so Parquet
        # statistics spare a load of recent files most of the table.
        known = known.filter(F.col("event_id").between(lines.low, lines.high))
    refused = 0
    if lines.ok == lines.total:
        first = lines.rows.groupBy("event_id").agg(F.min(F.struct(*PLACE)).alias("place"))
    else:
        ids = stored(id_table(lines.rows))
        good = ids.filter(F.col("good").isNotNull())
        failed, refused = stored_and_counted(failures(ids, known))
        good = without_files(good, failed, refused)
        names = failed.withColumnRenamed("source_file", "file_path")
        described = described.join(names, "file_path", "left_anti")
        _reject(names, INVALID, lake_dir, moment)
        first = good.groupBy("event_id").agg(
            F.min(F.struct("source_file", "good.*")).alias("place")
        )
    first = first.select("event_id", "place.*")
    if large:
        fresh = id_index.drop_indexed(spark, lake_dir, first)
    else:
        fresh = drop_existing(first, known, lines.ok)
    fresh, inserted = stored_and_counted(fresh)
    rows = _at_places(lines.rows, fresh, inserted, lines.total).select("*", loaded_at)
    if write_events(rows, lake_dir, batch_id) != inserted:
        raise RuntimeError("the written events are not those that were chosen")
    if large:
        id_index.cover(spark, lake_dir, fresh, batch_id, moment)
    else:
        id_index.keep(fresh, lake_dir, batch_id)
    commit_files(
        described.select("*", loaded_at, F.lit(batch_id).alias("batch_id")), lake_dir
    )
    return len(files) - refused, inserted


def _at_places(staged: DataFrame, chosen: DataFrame, count: int, total: int) -> DataFrame:
    """The ``count`` chosen of all ``total`` lines.

    Few chosen lines, or few others, are broadcast; in between, places are joined.
    """
    if count == total:
        return staged
    places = chosen.select(*PLACE)
    if count > MAX_BROADCAST_ROWS and total - count <= MAX_BROADCAST_ROWS:
        others = staged.select(*PLACE).join(places, PLACE, "left_anti")
        return staged.join(F.broadcast(others), PLACE, "left_anti")
    return staged.join(within_bound(places, count), PLACE, "left_semi")


def _compare_listing(listing: DataFrame, manifest: DataFrame) -> DataFrame:
    known = manifest.select(
        "file_path",
        F.col("file_size").alias("known_size"),
        F.col("file_mtime").alias("known_mtime"),
    )
    return listing.join(known, "file_path", "left")


def _by_name(files: DataFrame) -> Iterator[Row]:
    """Known files, then new ones, each by name, fetched a partition at a time.

    In name order the first file with an event wins across commits. File names,
    never contents, pass through the driver, which lists the folder anyway.
    """
    columns = ["path", "file_path", "file_size", "file_mtime", "is_known"]
    ordered = files.select(*columns).orderBy(F.desc("is_known"), "file_path")
    return ordered.toLocalIterator()


def _chunks(
    files: Iterator[Row], max_files: int, max_bytes: int
) -> Iterator[list[Row]]:
    chunk: list[Row] = []
    size = 0
    for file in files:
        if chunk and (len(chunk) == max_files or size + file.file_size > max_bytes):
            yield chunk
            chunk, size = [], 0
        chunk.append(file)
        size += file.file_size
    if chunk:
        yield chunk


def _report_modified(
    spark: SparkSession, files: list[Row], lake_dir: str, moment: datetime
) -> None:
    current = fingerprints(spark, files)
    compared = classify_files(current, read_manifest(spark, lake_dir))
    modified = stored(compared.filter(F.col("status") == "modified").select("file_path"))
    _reject(modified, MODIFIED, lake_dir, moment)


def _reject(names: DataFrame, reason: str, lake_dir: str, moment: datetime) -> None:
    """Record the files in ``rejected_files`` and log every one."""
    if names.isEmpty():
        return
    record_rejected(
        names.select("file_path", F.lit(reason).alias("reason"), ntz(moment).alias("rejected_at")),
        lake_dir,
    )
    for row in names.orderBy("file_path").toLocalIterator():
        logger.warning("%s: %s", reason, row.file_path)


def retry_rejected(spark: SparkSession, raw_dir: str, lake_dir: str) -> int:
    """Load files that were refused for their lines and still lie in the folder.

    For the stream, which never offers a file twice; returns files loaded.
    """
    refused = read_rejected(spark, lake_dir).filter(F.col("reason") == INVALID)
    known = read_manifest(spark, lake_dir)
    open_ = refused.select("file_path").distinct().join(known, "file_path", "left_anti")
    if open_.isEmpty():
        return 0
    files = list_files(spark, raw_dir).join(open_, "file_path", "left_semi")
    listed = files.orderBy("file_path").toLocalIterator()
    loaded = 0
    for chunk in _chunks(listed, MAX_BATCH_FILES, MAX_BATCH_BYTES):
        lines = read_lines(spark, [file.path for file in chunk])
        loaded += load_batch(lines, chunk, lake_dir, naive_utc())[0]
    return loaded
