"""Raw JSON-lines files: listing, fingerprints, lines with their place."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from logweir.functions.jsonlines import is_blank
from logweir.functions.time import naive
from logweir.plans.shared import escaped

RAW_PATTERN = "*.jsonl"
# Folders written by land_events, and the files in them.
LANDED_FOLDERS = "landed_*"
LANDED_PATTERN = "part-*.txt"

# A file up to this size is hashed from memory, a larger one in pieces.
MAX_HASH_BYTES = 1 << 30
PIECE = 8 << 20

LISTING = "path string, file_path string, file_size long, file_mtime timestamp_ntz"
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def file_name() -> Column:
    """The base name as it is on disk; Spark's metadata has it URL-encoded."""
    encoded = F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B"))
    return F.url_decode(encoded)


def read_or_none(read, path: str) -> DataFrame | None:
    """``read(path)``, or ``None`` where nothing lies at a path or matches a pattern."""
    spark = SparkSession.active()
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark._jsc.hadoopConfiguration())
    found = store.globStatus(place)
    return read(path) if found is not None and len(found) else None


def _described() -> list[Column]:
    return [
        file_name().alias("file_path"),
        F.col("_metadata.file_size").alias("file_size"),
        naive(F.col("_metadata.file_modification_time")).alias("file_mtime"),
    ]


def list_files(
    spark: SparkSession, raw_dir: str, landed: list[str] | None = None
) -> DataFrame:
    """``path, file_path, file_size, file_mtime`` of each raw file.

    ``file_path`` is the base name, ``raw_dir`` is taken literally. Subfolders are not
    searched, except those written by ``land_events``: all of them, or only the
    ``landed`` ones. Many folders are listed by tasks. No content is read. Spark's
    sources give no row for a file of zero length; those are added from the listing.
    """
    folder = escaped(raw_dir)

    def read(pattern: str):
        return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load

    if landed is None:
        inner = read_or_none(read(LANDED_PATTERN), f"{folder}/{LANDED_FOLDERS}")
    else:
        inner = read(LANDED_PATTERN)(list(map(escaped, landed))) if landed else None
    listings = []
    for found in (read_or_none(read(RAW_PATTERN), folder), inner):
        if found is not None:
            filled = found.select("path", *_described())
            listings += [filled, *_empty_files(spark, found, filled)]
    if not listings:
        return spark.createDataFrame([], LISTING)
    return reduce(DataFrame.union, listings)


def _empty_files(
    spark: SparkSession, found: DataFrame, filled: DataFrame
) -> list[DataFrame]:
    """Listed files that give no row.

    Spark's reader holds the listing in the driver's JVM; it is compared there and in
    tasks, and only the names of empty files come to Python.
    """
    jvm, names = spark._jvm, found._jdf.inputFiles()
    if len(names) == filled.count():
        return []
    listed = spark.range(1).select(F.explode(Column(jvm.org.apache.spark.sql.functions.lit(names))))
    listed = listed.toDF("url")
    plain = F.url_decode(F.replace("url", F.lit("+"), F.lit("%2B")))
    # The two write the root of a local path in different ways.
    plain = F.regexp_replace(plain, "^file:/+", "file:/")
    silent = listed.withColumn("path", plain).join(filled, "path", "left_anti")
    conf = spark._jsc.hadoopConfiguration()
    rows = []
    for row in silent.toLocalIterator():
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(row.url))
        status = path.getFileSystem(conf).getFileStatus(path)
        rows.append((row.path, path.getName(), status.getLen(), status.getModificationTime()))
    schema = "path string, file_path string, file_size long, millis long"
    return [
        spark.createDataFrame(rows, schema).select(
            "path",
            "file_path",
            "file_size",
            naive(F.timestamp_millis("millis")).alias("file_mtime"),
        )
    ]


def fingerprints(spark: SparkSession, files: list[Row]) -> DataFrame:
    """``file_path, file_size, file_mtime, file_sha256`` of the given files.

    Always the SHA-256 of the bytes. ``files`` have path, file_path and file_size;
    files of zero length also need their file_mtime.
    """
    empty = [f for f in files if f.file_size == 0]
    small = [f.path for f in files if 0 < f.file_size <= MAX_HASH_BYTES]
    large = [f.path for f in files if f.file_size > MAX_HASH_BYTES]
    hashed = []
    if small:
        content = spark.read.format("binaryFile").load(list(map(escaped, small)))
        hashed.append(
            content.select(*_described(), F.sha2("content", 256).alias("file_sha256"))
        )
    if large:
        hashed.append(_hashed_in_pieces(spark, large))
    if empty:
        rows = [(f.file_path, 0, f.file_mtime, EMPTY_SHA256) for f in empty]
        schema = "file_path string, file_size long, file_mtime timestamp_ntz, file_sha256 string"
        hashed.append(spark.createDataFrame(rows, schema))
    return reduce(DataFrame.union, hashed)


def _hashed_in_pieces(spark: SparkSession, paths: list[str]) -> DataFrame:
    """One task per file reads it piece by piece, in constant memory."""
    listed = spark.read.format("binaryFile").load(list(map(escaped, paths)))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        for frame in frames:
            hashes = []
            for path in frame["path"]:
                store, name = (
                    fs.FileSystem.from_uri(path)
                    if re.match(r"(?!file:)[a-z0-9]+://", path)
                    else (fs.LocalFileSystem(), re.sub("^file:/*", "/", path))
                )
                total = hashlib.sha256()
                with store.open_input_stream(name) as stream:
                    while piece := stream.read(PIECE):
                        total.update(piece)
                hashes.append(total.hexdigest())
            yield frame.assign(file_sha256=hashes)

    columns = ["file_path", "file_size", "file_mtime"]
    described = listed.select("path", *_described()).repartition(len(paths), "path")
    return described.mapInPandas(run, f"{LISTING}, file_sha256 string").select(
        *columns, "file_sha256"
    )


def file_and_block() -> list[Column]:
    return [
        file_name().alias("source_file"),
        F.col("_metadata.file_block_start").alias("block_start"),
    ]


def line_number() -> Column:
    """Grows with the line within one block of a file."""
    return F.monotonically_increasing_id().alias("line")


def read_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Lines that are not blank, with ``source_file, block_start, line``."""
    lines = spark.read.text(list(map(escaped, paths))).select("value", *file_and_block(), line_number())
    return lines.filter(~is_blank(F.col("value")))
