"""Time anchors and parameter checks.

Every timestamp is naive UTC (``TIMESTAMP_NTZ``). Literals are built from ISO
text: a Python ``datetime`` passed to ``F.lit`` would be read in the client's
zone and shift.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def positive(name: str, value: int) -> int:
    if isinstance(value, bool) or not isinstance(value, int) or value <= 0:
        raise ValueError(f"{name} must be a positive integer, got {value!r}")
    return value


def naive_utc(moment: datetime | str | None = None) -> datetime:
    """Now, or the given moment, as a naive UTC ``datetime``."""
    if moment is None:
        moment = datetime.now(timezone.utc)
    elif isinstance(moment, str):
        moment = datetime.fromisoformat(moment)
    if moment.tzinfo is not None:
        moment = moment.astimezone(timezone.utc).replace(tzinfo=None)
    return moment


def ntz(moment: datetime | str) -> Column:
    return F.lit(naive_utc(moment).isoformat()).cast("timestamp_ntz")


def naive(instant: Column) -> Column:
    """An instant as naive UTC, whatever the session zone."""
    micros = F.unix_micros(instant).cast("decimal(38,0)")
    seconds = (micros / 1000000).cast("decimal(18,6)")
    return ntz("1970-01-01") + F.make_dt_interval(secs=seconds)


def instant(naive_time: Column) -> Column:
    """The instant a naive UTC time stands for, whatever the session zone."""
    return F.concat(naive_time.cast("string"), F.lit("Z")).cast("timestamp")


def window_start(days: int, as_of: datetime | str | None = None) -> datetime:
    return naive_utc(as_of) - timedelta(days=positive("days", days))


def interval(text: str) -> Column:
    return F.expr(f"INTERVAL {text}")


def since(events: DataFrame, start: datetime | Column, *, strict: bool) -> DataFrame:
    """Rows created after ``start`` (a moment or a constant), with no upper bound.

    On the stored table the day column is filtered too, so that older
    partitions are pruned before any file is opened.
    """
    bound = start if isinstance(start, Column) else ntz(start)
    created = F.col("created_at")
    if "created_date" in events.columns:
        events = events.filter(F.col("created_date") >= bound.cast("date"))
    return events.filter(created > bound if strict else created >= bound)


def hour_of(column: str) -> Column:
    """The hour bucket, still ``TIMESTAMP_NTZ``.

    ``date_trunc`` would answer in the session zone and is wrong where that
    zone skips an hour.
    """
    return F.window(column, "1 hour")["start"]
