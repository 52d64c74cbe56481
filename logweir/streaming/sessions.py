"""Gap sessions on a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweir.functions.time import instant
from logweir.operators.sessions import GAP


def stream_sessions(
    events: DataFrame, *, gap: str = GAP, lateness: str = "10 minutes"
) -> DataFrame:
    """Sessions per actor, final once the watermark has passed them by a gap.

    Rows later than ``lateness`` may be dropped. Sessions are not numbered: the
    first one of an actor is not known on a stream. A watermark needs instants,
    hence the detour for the naive times.
    """
    return (
        events.filter(F.col("actor_login").isNotNull())
        .withColumn("at", instant(F.col("created_at")))
        .withWatermark("at", lateness)
        .groupBy("actor_login", F.session_window("at", gap).alias("session"))
        .agg(
            F.min("created_at").alias("session_start_at"),
            F.max("created_at").alias("session_end_at"),
            F.count(F.lit(1)).alias("events_in_session"),
        )
        .drop("session")
    )
