"""Gap sessions per actor: a pause longer than the gap starts a new one."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from logweir.functions.time import (
    interval,
    naive_utc,
    ntz,
    positive,
    since,
    window_start,
)

GAP = "30 minutes"

ORDER = ["created_at", "event_id"]

# Events of an actor's day, or hour, that are still sorted in one piece.
MAX_ROWS_PER_RUN = 1_000_000

_SO_FAR = (W.unboundedPreceding, W.currentRow)
_EARLIER = (W.unboundedPreceding, -1)


def session_scan(
    events: DataFrame,
    *,
    days: int = 7,
    as_of: datetime | str | None = None,
    gap: str = GAP,
) -> DataFrame:
    """Events of known actors from one gap before the window onwards.

    Sessions reaching back further are clipped here, and numbering starts here.
    """
    start = ntz(window_start(days, as_of)) - interval(gap)
    return since(events, start, strict=False).filter(F.col("actor_login").isNotNull())


def _starts(at: Column, before: Column, gap: str) -> Column:
    """1 where ``at`` opens a session; exactly one gap still continues it."""
    return F.when(before.isNull() | (at - before > interval(gap)), 1).otherwise(0)


def _slotted(events: DataFrame, max_rows: int) -> DataFrame:
    """``events`` with ``run_``, their day, and ``slot_``, the first minute of the
    stretch of it they are sorted in.

    That is the whole day; an hour where an actor's day has more than ``max_rows``
    events; a minute where the hour has more as well. Only such days are in the table
    that is broadcast: one row per ``max_rows`` events at the most.
    """
    day, hour = F.col("created_at").cast("date"), F.hour("created_at")
    hours = events.groupBy(
        F.col("actor_login").alias("actor_"), day.alias("day_"), hour.alias("hour_")
    ).agg(F.count(F.lit(1)).alias("n_"))
    busy = (
        hours.groupBy("actor_", "day_")
        .agg(
            F.sum("n_").alias("rows_"),
            F.collect_set(F.when(F.col("n_") > max_rows, F.col("hour_"))).alias("busy_"),
        )
        .filter(F.col("rows_") > max_rows)
        .drop("rows_")
    )
    slot = (
        F.when(F.col("busy_").isNull(), 0)
        .when(F.array_contains("busy_", hour), hour * 60 + F.minute("created_at"))
        .otherwise(hour * 60)
    )
    same = (F.col("actor_login") == F.col("actor_")) & (F.col("run_") == F.col("day_"))
    return (
        events.withColumn("run_", day)
        .join(F.broadcast(busy), same, "left")
        .withColumn("slot_", slot)
        .drop("actor_", "day_", "busy_")
    )


def sessionize(
    events: DataFrame, gap: str = GAP, *, max_rows_per_run: int = MAX_ROWS_PER_RUN
) -> DataFrame:
    """Events with ``event_sequence, prev_created_at, is_new_session, session_id``.

    Rows without an actor are dropped. One lazy plan for every size: windows run
    over an actor's days, busy days by hours or minutes, and each such run gets three
    facts from the runs before it, so that no window has to sort a busy actor alone.
    Runs are few.

    These are how many events they hold, how many sessions they open, and when
    the last one ends.
    """
    positive("max_rows_per_run", max_rows_per_run)
    known = events.filter(F.col("actor_login").isNotNull())
    runs = _slotted(known, max_rows_per_run)
    in_run = W.partitionBy("actor_login", "run_", "slot_").orderBy(*ORDER)
    local = runs.select(
        "*",
        F.row_number().over(in_run).alias("row_"),
        F.lag("created_at").over(in_run).alias("lag_"),
    ).withColumn(
        "inner_",
        F.when(F.col("row_") == 1, 0).otherwise(
            _starts(F.col("created_at"), F.col("lag_"), gap)
        ),
    )
    edges = local.groupBy("actor_login", "run_", "slot_").agg(
        F.count(F.lit(1)).alias("rows_"),
        F.sum("inner_").alias("breaks_"),
        F.min("created_at").alias("first_"),
        F.max("created_at").alias("last_"),
    )
    # One row per run of an actor.
    by_run = W.partitionBy("actor_login").orderBy("run_", "slot_")
    before = (
        edges.withColumn("edge_", F.lag("last_").over(by_run))
        .withColumn("opens_", _starts(F.col("first_"), F.col("edge_"), gap))
        .select(
            "actor_login",
            "run_",
            "slot_",
            "edge_",
            "opens_",
            F.coalesce(
                F.sum("rows_").over(by_run.rowsBetween(*_EARLIER)), F.lit(0)
            ).alias("rows_before_"),
            F.coalesce(
                F.sum(F.col("breaks_") + F.col("opens_")).over(
                    by_run.rowsBetween(*_EARLIER)
                ),
                F.lit(0),
            ).alias("sessions_before_"),
        )
    )
    first = F.col("row_") == 1
    # Events without a time have no day; they come first, as in any ascending sort.
    same = F.col("actor_login") == F.col("actor_")
    same &= F.col("run_").eqNullSafe(F.col("at_"))
    same &= F.col("slot_").eqNullSafe(F.col("minute_"))
    before = before.withColumnsRenamed(
        {"actor_login": "actor_", "run_": "at_", "slot_": "minute_"}
    )
    return local.join(before, same).select(
        *events.columns,
        (F.col("rows_before_") + F.col("row_")).alias("event_sequence"),
        F.when(first, F.col("edge_")).otherwise(F.col("lag_")).alias("prev_created_at"),
        F.when(first, F.col("opens_")).otherwise(F.col("inner_")).alias(
            "is_new_session"
        ),
        (
            F.col("sessions_before_")
            + F.col("opens_")
            + F.sum("inner_").over(in_run.rowsBetween(*_SO_FAR))
        ).alias("session_id"),
    )


def session_totals(events: DataFrame, gap: str = GAP) -> DataFrame:
    """One row per session, without ordering single events.

    Events of one actor inside one gap-wide time slot are less than a gap
    apart, so a slot never splits and its first, last and count are all that
    matters. Slots are combined map-side, which takes care of hot actors; the
    window then sees at most (time span / gap) rows per actor.
    """
    slots = (
        events.filter(F.col("actor_login").isNotNull())
        .groupBy("actor_login", F.window("created_at", gap)["start"].alias("slot"))
        .agg(
            F.min("created_at").alias("first_at"),
            F.max("created_at").alias("last_at"),
            F.count(F.lit(1)).alias("n"),
        )
    )
    by_actor = W.partitionBy("actor_login").orderBy("slot")
    starts = slots.withColumn(
        "starts", _starts(F.col("first_at"), F.lag("last_at").over(by_actor), gap)
    )
    return (
        starts.withColumn(
            "session_id", F.sum("starts").over(by_actor.rowsBetween(*_SO_FAR))
        )
        .groupBy("actor_login", "session_id")
        .agg(
            F.min("first_at").alias("session_start_at"),
            F.max("last_at").alias("session_end_at"),
            F.sum("n").alias("events_in_session"),
        )
    )


def user_sessions(
    events: DataFrame,
    *,
    days: int = 7,
    limit: int | None = 50,
    as_of: datetime | str | None = None,
    gap: str = GAP,
) -> DataFrame:
    """Sessions ending inside the window, by actor and latest start first.

    ``limit=None`` returns every session, unsorted.
    """
    as_of = naive_utc(as_of)
    totals = session_totals(session_scan(events, days=days, as_of=as_of, gap=gap), gap)
    recent = totals.filter(F.col("session_end_at") >= ntz(window_start(days, as_of)))
    if limit is None:
        return recent
    return recent.orderBy("actor_login", F.desc("session_start_at")).limit(
        positive("limit", limit)
    )
