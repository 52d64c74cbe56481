"""Repositories ranked by activity in a time window."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweir.functions.time import positive, since, window_start


def top_repos(
    events: DataFrame,
    *,
    days: int = 30,
    limit: int = 10,
    as_of: datetime | str | None = None,
    push_type: str = "PushEvent",
) -> DataFrame:
    """The ``limit`` repositories with most events; ties go by name.

    Unique users are exact. Spark first groups by repository and user, so a hot
    repository is spread over its users before it is brought together.
    """
    positive("limit", limit)
    recent = since(events, window_start(days, as_of), strict=True)
    return (
        recent.groupBy("repo_name")
        .agg(
            F.count(F.lit(1)).alias("total_events"),
            F.countDistinct("actor_login").alias("unique_users"),
            F.count_if(F.col("event_type") == push_type).alias("push_events"),
            F.min("created_at").alias("first_event_at"),
            F.max("created_at").alias("last_event_at"),
        )
        .orderBy(F.desc("total_events"), F.asc_nulls_last("repo_name"))
        .limit(limit)
        .withColumn("processed_at", F.current_timestamp())
    )
