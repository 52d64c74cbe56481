"""Landing: raw event text, stamped and written in small immutable files."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweir.functions.jsonlines import add_ingested_at
from logweir.functions.time import naive_utc, positive

MAX_RECORDS = 150

# On a local disk, Hadoop keeps a checksum file beside every file and starts processes
# to set the rights of both; the load takes a SHA-256 of its own. Other stores are not
# touched by this.
NO_CHECKSUM_FILES = {
    "fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem",
    "fs.file.impl.disable.cache": "true",
}


def land_events(
    events: DataFrame,
    raw_dir: str,
    *,
    max_records: int = MAX_RECORDS,
    ingest_ts: datetime | str | None = None,
) -> str:
    """Write the JSON objects in ``value`` below ``raw_dir``; return the folder.

    Every object gets ``_ingested_at``; no file holds more than ``max_records``
    of them. Each call has a folder of its own, so calls never collide.
    """
    moment = naive_utc(ingest_ts)
    folder = f"{raw_dir}/landed_{moment:%Y%m%d_%H%M%S}_{uuid.uuid4().hex[:8]}"
    stamped = events.select(add_ingested_at(F.col("value"), moment).alias("value"))
    (
        stamped.write.option("maxRecordsPerFile", positive("max_records", max_records))
        .options(**NO_CHECKSUM_FILES)
        .mode("errorifexists")
        .text(folder)
    )
    return folder
