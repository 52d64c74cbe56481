"""Landed folders, and the ledger of those that were loaded whole.

A landed folder does not change once it is finished. When all its files are loaded, one
row of ``landed_folders`` says so, and later loads do not list it again.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweir.functions.time import ntz
from logweir.plans.shared import escaped, within_bound
from logweir.schemas import LANDED_FOLDERS as LEDGER
from logweir.sources.lake import read_manifest, read_table
from logweir.sources.rawfiles import LANDED_FOLDERS

LEDGER_FOLDER = "landed_folders"

# Spark writes it when all files of a folder are in place.
FINISHED = "_SUCCESS"


@dataclass(frozen=True)
class Landed:
    """Folders to list, those of them that will not change, and the files of the others."""

    to_list: list[str]
    finished: list[str]
    files_loaded: int


def read_ledger(spark: SparkSession, lake_dir: str) -> DataFrame:
    """One row per folder: ``folder, files, recorded_at``."""
    rows = read_table(spark, f"{lake_dir}/{LEDGER_FOLDER}", LEDGER)
    return rows.groupBy("folder").agg(F.max("files").alias("files"))


def look_up(spark: SparkSession, raw_dir: str, lake_dir: str, *, all_folders: bool = False) -> Landed:
    """Compare the landed folders with the ledger; no file is listed.

    One name per call of ``land_events`` passes the driver, however many files it wrote.
    ``all_folders`` has the known ones listed too.
    """
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{escaped(raw_dir)}/{LANDED_FOLDERS}")
    store = place.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [s.getPath().toString() for s in store.globStatus(place) or [] if s.isDirectory()]
    if not found:
        return Landed([], [], 0)
    names = spark.createDataFrame([(name,) for name in found], "folder string")
    known = {
        row.folder: row.files
        for row in read_ledger(spark, lake_dir)
        .join(within_bound(names, len(found)), "folder", "left_semi")
        .toLocalIterator()
    }
    open_ = [name for name in found if name not in known]
    path = spark._jvm.org.apache.hadoop.fs.Path
    finished = [name for name in open_ if store.exists(path(f"{name}/{FINISHED}"))]
    if all_folders:
        return Landed(found, finished, 0)
    return Landed(open_, finished, sum(known.values()))


def record(
    spark: SparkSession, listing: DataFrame, landed: Landed, lake_dir: str, moment: datetime
) -> int:
    """Enter the finished folders whose listed files are all loaded; return how many.

    ``listing`` was made after ``landed``, so a finished folder was listed whole. A
    folder with a refused file stays open and is tried again.
    """
    if not landed.finished:
        return 0
    names = spark.createDataFrame([(name,) for name in landed.finished], "folder string")
    loaded = read_manifest(spark, lake_dir).select("file_path", F.lit(True).alias("loaded"))
    whole = (
        listing.withColumn("folder", F.regexp_replace("path", "/[^/]*$", ""))
        .join(within_bound(names, len(landed.finished)), "folder", "left_semi")
        .join(loaded, "file_path", "left")
        .groupBy("folder")
        .agg(F.count(F.lit(1)).alias("files"), F.count("loaded").alias("loaded"))
        .filter(F.col("files") == F.col("loaded"))
        .select("folder", "files", ntz(moment).alias("recorded_at"))
    )
    # One row per folder, at most those just looked at.
    rows = whole.collect()
    if rows:
        (
            spark.createDataFrame(rows, LEDGER)
            .coalesce(1)
            .write.mode("append")
            .parquet(f"{lake_dir}/{LEDGER_FOLDER}")
        )
    return len(rows)
