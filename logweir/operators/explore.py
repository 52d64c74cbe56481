"""Small rollups for looking around in the events table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweir.functions.time import hour_of, positive


def event_count(events: DataFrame) -> DataFrame:
    return events.agg(F.count(F.lit(1)).alias("event_count"))


def events_per_type(events: DataFrame) -> DataFrame:
    return (
        events.groupBy("event_type")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), "event_type")
    )


def _most_frequent(events: DataFrame, key: str, limit: int) -> DataFrame:
    return (
        events.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("event_count"))
        .orderBy(F.desc("event_count"), key)
        .limit(positive("limit", limit))
    )


def repo_counts(events: DataFrame, limit: int = 10) -> DataFrame:
    return _most_frequent(events, "repo_name", limit)


def most_active_users(events: DataFrame, limit: int = 10) -> DataFrame:
    return _most_frequent(events, "actor_login", limit)


def events_per_hour(events: DataFrame, limit: int = 24) -> DataFrame:
    """The latest ``limit`` hours that have events."""
    return (
        events.groupBy(hour_of("created_at").alias("hour"))
        .agg(F.count(F.lit(1)).alias("event_count"))
        .orderBy(F.desc("hour"))
        .limit(positive("limit", limit))
    )


def recent_repo_events(events: DataFrame, repo: str, limit: int = 20) -> DataFrame:
    """The latest events of one repository, newest first."""
    return (
        events.filter(F.col("repo_name") == repo)
        .select("event_id", "event_type", "actor_login", "created_at")
        .orderBy(F.desc("created_at"), F.desc("event_id"))
        .limit(positive("limit", limit))
    )
