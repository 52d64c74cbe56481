"""Events of each repository as an ordered list of structs, in two versions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from logweir.functions.time import positive

ELEMENT_FIELDS = {
    1: ["event_id", "actor_login", "event_type", "created_at"],
    2: ["event_id", "actor_login", "event_type", "created_at", "repo_id"],
}
LATEST = max(ELEMENT_FIELDS)

# Elements of one output row; the next ones go to a further part.
MAX_EVENTS_PER_ROW = 1_000_000

ORDER = ["created_at", "event_id"]


def _fields(version: int | None) -> list[str]:
    version = LATEST if version is None else version
    if version not in ELEMENT_FIELDS:
        raise ValueError(f"unknown version {version!r}, have {sorted(ELEMENT_FIELDS)}")
    return ELEMENT_FIELDS[version]


def _ordered_list(fields: list[str]):
    """Collect with the order columns first, sort, restore the field order."""
    sort_first = ORDER + [name for name in fields if name not in ORDER]
    rows = F.sort_array(F.collect_list(F.struct(*sort_first)))
    return F.transform(
        rows, lambda row: F.struct(*(row[name].alias(name) for name in fields))
    ).alias("events")


def repo_events_nested(
    events: DataFrame,
    version: int | None = None,
    *,
    max_events_per_row: int = MAX_EVENTS_PER_ROW,
) -> DataFrame:
    """``repo_name, part, first_position, events``, NULL name included.

    Parts 0, 1, ... of a repository, read in order, are its whole list; each has
    ``max_events_per_row`` events, the last one what is left. ``first_position``
    is the place of a part's first event, from 1. One lazy plan for every size:
    events are ranked within a repository's day, and days are offset by the days
    before, so that no window has to sort a large repository alone.
    """
    fields = _fields(version)
    positive("max_events_per_row", max_events_per_row)
    dated = events.select("repo_name", *fields).withColumn(
        "day_", F.col("created_at").cast("date")
    )
    same = F.col("repo_name").eqNullSafe(F.col("of_")) & F.col("day_").eqNullSafe(F.col("at_"))
    in_day = W.partitionBy("repo_name", "day_").orderBy(*ORDER)
    placed = (
        dated.withColumn("row_", F.row_number().over(in_day))
        .join(_before_each_day(dated), same)
        .withColumn("place_", F.col("before_") + F.col("row_") - 1)
        .withColumn("part", F.floor(F.col("place_") / max_events_per_row))
    )
    return (
        placed.groupBy("repo_name", "part")
        .agg((F.min("place_") + 1).alias("first_position"), _ordered_list(fields))
        .select("repo_name", "part", "first_position", "events")
    )


def _before_each_day(dated: DataFrame) -> DataFrame:
    """How many events a repository has before each of its days."""
    sizes = dated.groupBy("repo_name", "day_").agg(F.count(F.lit(1)).alias("rows_"))
    earlier = (
        W.partitionBy("repo_name").orderBy("day_").rowsBetween(W.unboundedPreceding, -1)
    )
    return sizes.select(
        F.col("repo_name").alias("of_"),
        F.col("day_").alias("at_"),
        F.coalesce(F.sum("rows_").over(earlier), F.lit(0)).alias("before_"),
    )


# The former name of the form in parts, which is now the only one.
repo_events_nested_parts = repo_events_nested


def flatten_parts(parts: DataFrame) -> DataFrame:
    """One row per list element, ``position`` counting from 1."""
    return parts.select(
        "repo_name", "first_position", F.posexplode("events").alias("at_", "event")
    ).select(
        "repo_name", (F.col("first_position") + F.col("at_")).alias("position"), "event.*"
    )


def list_lengths(parts: DataFrame) -> DataFrame:
    return parts.groupBy("repo_name").agg(
        F.sum(F.size("events")).alias("events_in_list")
    )


def first_and_last(parts: DataFrame) -> DataFrame:
    """Ids of the first and last list element, and the first one's repo id."""
    ends = parts.select(
        "repo_name",
        "part",
        F.get("events", F.lit(0)).alias("head"),
        F.get("events", F.size("events") - 1).alias("tail"),
    )
    return (
        ends.groupBy("repo_name")
        .agg(F.min_by("head", "part").alias("head"), F.max_by("tail", "part").alias("tail"))
        .select(
            "repo_name",
            F.col("head.event_id").alias("first_event_id"),
            F.col("head.repo_id").alias("first_repo_id"),
            F.col("tail.event_id").alias("last_event_id"),
        )
    )


def create_views(events: DataFrame) -> None:
    """Temp views ``events``, both nested versions, and the newest one's alias.

    A view is a definition: nothing runs here. The names ending in ``_parts`` are
    the same views.
    """
    events.createOrReplaceTempView("events")
    names = {f"repo_events_nested_v{v}": v for v in ELEMENT_FIELDS}
    names["repo_events_nested"] = LATEST
    for name, version in names.items():
        nested = repo_events_nested(events, version)
        nested.createOrReplaceTempView(name)
        nested.createOrReplaceTempView(f"{name}_parts")
