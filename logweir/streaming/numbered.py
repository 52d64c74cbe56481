"""Numbered gap sessions on a stream, with the rows that came too late."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from logweir.functions.time import instant, ntz
from logweir.operators.sessions import GAP

# Keyed state with timers needs this store; set it before the stream starts.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    )
}

SESSION = ["actor_login", "session_id", "session_start_at", "session_end_at", "events_in_session"]
LATE = ["actor_login", "event_id", "created_at"]

# Times are microseconds since 1970; a late row has no session, a session no event.
_ROWS = "actor_login string, session_id long, first long, last long, events_in_session long, event_id string, at long"


def merged_spans(first: np.ndarray, last: np.ndarray, n: np.ndarray, gap: int):
    """Spans joined where the pause between them is at most ``gap``, in order of time."""
    order = np.argsort(first, kind="stable")
    first, last, n = first[order], last[order], n[order]
    reach = np.maximum.accumulate(last)
    heads = np.flatnonzero(np.r_[True, first[1:] - reach[:-1] > gap])
    return first[heads], np.maximum.reduceat(last, heads), np.add.reduceat(n, heads)


class _Numbered(StatefulProcessor):
    """Per actor: the spans still open, and how many were closed before them.

    Each call on the state is a round trip, and there is an actor's worth of them for
    every actor: the state is one value, with the time of the actor's only timer.
    """

    def __init__(self, gap: int) -> None:
        self.gap = gap

    def init(self, handle) -> None:
        self.handle = handle
        # Spans are int64 first, last and n, one column after the other.
        self.actor = handle.getValueState("actor", "closed long, wake long, spans binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        mark = max(timerValues.getCurrentWatermarkInMs(), 0) * 1000
        closed, wake, kept = self._state()
        spans = kept
        for frame in rows:
            at = frame["at"].to_numpy(np.int64)
            late = (at < mark) & (mark > 0)
            if late.any():
                told = frame.loc[late, ["event_id", "at"]]
                yield self._rows(key, event_id=told["event_id"].to_numpy(), at=told["at"].to_numpy())
                at = at[~late]
            if len(at):
                ones = np.ones(len(at), np.int64)
                both = [np.concatenate(pair) for pair in zip(spans, (at, at, ones), strict=True)]
                spans = merged_spans(*both, self.gap)
        if spans is not kept:
            self._keep(closed, wake, spans)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        before, _, spans = self._state()
        # No row that is not late can reach back to these.
        done = spans[1] + self.gap < mark
        count = int(done.sum())
        # The timer that has come is deleted when this is over.
        self._keep(before + count, None, [column[~done] for column in spans])
        if count:
            first, last, n = (column[done] for column in spans)
            yield self._rows(
                key,
                session_id=np.arange(before + 1, before + count + 1),
                first=first,
                last=last,
                events_in_session=n,
            )

    def close(self) -> None:
        pass

    def _state(self) -> tuple[int, int | None, list[np.ndarray]]:
        closed, wake, spans = self.actor.get() or (0, None, b"")
        return closed, wake, list(np.frombuffer(spans, np.int64).reshape(3, -1))

    def _keep(self, closed: int, wake: int | None, spans) -> None:
        """Store the open spans and wake up when the first of them may close."""
        due = (int(spans[1].min()) + self.gap) // 1000 + 1 if len(spans[0]) else None
        if due != wake:
            if wake is not None:
                self.handle.deleteTimer(wake)
            if due is not None:
                self.handle.registerTimer(due)
        self.actor.update((closed, due, np.concatenate(spans).tobytes()))

    @staticmethod
    def _rows(key, **columns) -> pd.DataFrame:
        size = len(next(iter(columns.values())))
        nothing = pd.arrays.IntegerArray(np.zeros(size, np.int64), np.ones(size, bool))
        texts = {"actor_login": np.full(size, key[0], object), "event_id": np.full(size, None, object)}
        frame = {}
        for name in ["actor_login", "session_id", "first", "last", "events_in_session", "event_id", "at"]:
            if name in texts:
                frame[name] = columns.get(name, texts[name])
            elif name in columns:
                frame[name] = pd.arrays.IntegerArray(columns[name].astype(np.int64), np.zeros(size, bool))
            else:
                frame[name] = nothing
        return pd.DataFrame(frame, copy=False)


def _micros(spark: SparkSession, gap: str) -> int:
    start = "TIMESTAMP_NTZ '1970-01-01'"
    return spark.sql(f"SELECT timestampdiff(MICROSECOND, {start}, {start} + INTERVAL {gap})").first()[0]


def _time(name: str):
    seconds = F.col(name).cast("decimal(38,0)") / 1000000
    return ntz("1970-01-01") + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))


def numbered_sessions(
    events: DataFrame, *, gap: str = GAP, lateness: str = "10 minutes"
) -> DataFrame:
    """Closed sessions with their number, and late rows, of a stream of events.

    Columns are those of ``SESSION``, then ``event_id`` and ``created_at`` of a late
    row; a row has either. A session comes out once, when the watermark (the greatest
    time seen less ``lateness``) is past its end by more than the gap, and so in order of
    time: numbers per actor run from 1 without a hole, as in ``session_totals``. A row
    older than the watermark changes no session and comes out as late.

    Rows without an actor or a time are passed over. An actor's state is its open spans
    and one number, which stays. Rows of an actor come to Python in Arrow batches, and
    a batch is merged into spans before the next is read, so memory does not grow with
    a busy actor; its rows of one micro-batch go through one task, though.
    """
    known = events.filter(F.col("actor_login").isNotNull() & F.col("created_at").isNotNull())
    marked = known.select(
        "actor_login",
        F.col("event_id").cast("string").alias("event_id"),
        instant(F.col("created_at")).alias("moment"),
    ).withWatermark("moment", lateness)
    # Without the marked column Spark does not drop late rows before the operator.
    rows = marked.select("actor_login", "event_id", F.unix_micros("moment").alias("at"))
    found = rows.groupBy("actor_login").transformWithStateInPandas(
        _Numbered(_micros(events.sparkSession, gap)), _ROWS, "Append", "EventTime"
    )
    return found.select(
        "actor_login",
        "session_id",
        _time("first").alias("session_start_at"),
        _time("last").alias("session_end_at"),
        "events_in_session",
        "event_id",
        _time("at").alias("created_at"),
    )


def write_numbered_sessions(
    events: DataFrame,
    sessions_dir: str,
    late_dir: str,
    checkpoint_dir: str,
    *,
    gap: str = GAP,
    lateness: str = "10 minutes",
) -> StreamingQuery:
    """Write closed sessions and late rows to two folders, and stop when all is read.

    Each micro-batch replaces its own subfolders, so a repeated one adds nothing.
    """

    def write(batch: DataFrame, number: int) -> None:
        # Read twice, but worked out once: the state must not be asked again.
        batch.persist()
        try:
            closed = F.col("session_id").isNotNull()
            for keep, columns, folder in [(closed, SESSION, sessions_dir), (~closed, LATE, late_dir)]:
                part = batch.filter(keep).select(*columns)
                part.write.mode("overwrite").parquet(f"{folder}/batch={number}")
        finally:
            batch.unpersist()

    spark = events.sparkSession
    before = {name: spark.conf.get(name, None) for name in STATE_STORE}
    for name, value in STATE_STORE.items():
        spark.conf.set(name, value)
    try:
        # A query takes its settings from the session as it starts.
        return (
            numbered_sessions(events, gap=gap, lateness=lateness)
            .writeStream.outputMode("append")
            .foreachBatch(write)
            .option("checkpointLocation", checkpoint_dir)
            .trigger(availableNow=True)
            .start()
        )
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
