"""The load as a stream over the raw folder."""

from __future__ import annotations

import json
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from logweir.functions.jsonlines import is_blank
from logweir.functions.time import naive_utc
from logweir.operators.loading import parse_lines
from logweir.plans.shared import bounded_listing, escaped, within_bound
from logweir.schemas import LOADED_FILES
from logweir.sources.lake import read_table
from logweir.sources.loader import load_staged, retry_rejected, staged
from logweir.sources.rawfiles import (
    LANDED_FOLDERS,
    LANDED_PATTERN,
    RAW_PATTERN,
    file_and_block,
    line_number,
)


def not_known(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """The ``files`` of a micro-batch that are not in the manifest.

    The files go to the manifest, which is long, and only its hits come back: sent
    through the driver with every micro-batch, it would grow with its square.
    """
    names = manifest.select(F.col("file_path").alias("source_file"))
    hits = names.join(F.broadcast(files.select("source_file")), "source_file", "left_semi")
    return files.join(F.broadcast(hits), "source_file", "left_anti")


def stream_load(
    spark: SparkSession,
    raw_dir: str,
    lake_dir: str,
    checkpoint_dir: str,
    *,
    max_files_per_trigger: int = 1000,
    pattern: str | None = None,
    once: bool = True,
) -> StreamingQuery:
    """Load files as they arrive; ``once`` stops when the folder is worked off.

    Micro-batches hold whole files and commit like a load does, so a repeated
    micro-batch adds nothing. Among copies of an event the first to arrive
    wins, and by file name within a micro-batch. The folder's own files and those
    of landed subfolders are read, or with ``pattern`` only the folder's that match.
    A stream is offered a file once, so files refused before for their lines are
    tried again when a stream starts. Text is read once; the session's setting of the
    tasks that list files is lowered.
    """
    bounded_listing(spark)
    retry_rejected(spark, raw_dir, lake_dir)
    reader = spark.readStream.option("maxFilesPerTrigger", max_files_per_trigger)
    if pattern is None:
        both = f"{{{RAW_PATTERN},{LANDED_FOLDERS}/{LANDED_PATTERN}}}"
        found = reader.text(f"{escaped(raw_dir)}/{both}")
    else:
        found = reader.option("pathGlobFilter", pattern).text(escaped(raw_dir))
    lines = (
        found.select(
            "value",
            *file_and_block(),
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_size").alias("file_size"),
        )
    )

    def load(batch: DataFrame, _: int) -> None:
        session = batch.sparkSession
        # Files with blank lines only are among the names too. At most
        # max_files_per_trigger names come to the driver.
        seen, names = Observation(), F.struct("path", "source_file", "file_size")
        offered = batch.select("*", line_number()).observe(
            seen, F.to_json(F.collect_set(names)).alias("files")
        )
        lines = staged(parse_lines(offered.filter(~is_blank(F.col("value")))))
        files = json.loads(seen.get["files"])
        columns = "path string, source_file string, file_size long"
        files_read = session.createDataFrame(
            [(f["path"], f["source_file"], f["file_size"]) for f in files], columns
        )
        manifest = read_table(session, f"{lake_dir}/loaded_files", LOADED_FILES)
        new = [
            Row(path=unquote(row.path), file_path=row.source_file, file_size=row.file_size)
            for row in not_known(files_read, manifest.select("file_path")).collect()
        ]
        if not new:
            return
        if len(new) < len(files):
            wanted = session.createDataFrame(
                [(row.file_path,) for row in new], "source_file string"
            )
            wanted = within_bound(wanted, len(new))
            lines = staged(lines.rows.join(wanted, "source_file", "left_semi"))
        load_staged(lines, new, lake_dir, naive_utc())

    writer = lines.writeStream.foreachBatch(load).option(
        "checkpointLocation", checkpoint_dir
    )
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start()
