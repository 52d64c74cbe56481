import random
from datetime import datetime, timedelta

import pytest
from conftest import N
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from logweir import sessionize, user_sessions
from logweir.operators.sessions import _slotted, session_totals

COLUMNS = [
    "actor_login",
    "session_id",
    "session_start_at",
    "session_end_at",
    "events_in_session",
]


def minutes(*values):
    return [N + timedelta(minutes=v) for v in values]


def of(actor, times):
    return [(f"{actor}-{i}", actor, "r", t) for i, t in enumerate(times)]


def found(result):
    return [
        (r.actor_login, r.session_id, r.events_in_session) for r in result.collect()
    ]


def test_empty_keeps_columns(events):
    result = user_sessions(events(), as_of=N)
    assert result.columns == COLUMNS
    assert result.collect() == []


def test_single_event(events, any_zone):
    (row,) = user_sessions(events(("e", "ann", "r", N)), as_of=N).collect()
    assert tuple(row) == ("ann", 1, N, N, 1)


@pytest.mark.parametrize(
    "times, expected",
    [
        (minutes(0, 15, 29), [("ann", 1, 3)]),
        (minutes(0, 31), [("ann", 2, 1), ("ann", 1, 1)]),
        (minutes(0, 30), [("ann", 1, 2)]),
        (minutes(0, 30 + 1e-6 / 60), [("ann", 2, 1), ("ann", 1, 1)]),
    ],
)
def test_gap(events, any_zone, times, expected):
    assert found(user_sessions(events(*of("ann", times)), as_of=N)) == expected


def test_users_are_apart(events):
    rows = events(*of("a", minutes(0, 10)), *of("b", minutes(5)))
    assert found(user_sessions(rows, as_of=N)) == [("a", 1, 2), ("b", 1, 1)]


def test_session_across_the_start(events):
    start = N - timedelta(days=5)
    rows = of("a", [start - timedelta(minutes=10), start + timedelta(minutes=20)])
    assert found(user_sessions(events(*rows), days=5, as_of=N)) == [("a", 1, 2)]


def test_event_at_the_start_counts(events):
    rows = events(*of("a", [N - timedelta(days=5)]))
    assert found(user_sessions(rows, days=5, as_of=N)) == [("a", 1, 1)]


def test_clipped_half_an_hour_before_the_start(events):
    start = N - timedelta(days=5)
    times = [start + timedelta(minutes=m) for m in range(-120, 11, 10)]
    (row,) = user_sessions(events(*of("a", times)), days=5, as_of=N).collect()
    assert row.session_start_at == start - timedelta(minutes=30)
    assert (row.session_id, row.events_in_session) == (1, 5)


def test_numbering_counts_sessions_before_the_start(events):
    start = N - timedelta(days=5)
    times = [start - timedelta(minutes=20), start + timedelta(minutes=40)]
    assert found(user_sessions(events(*of("a", times)), days=5, as_of=N)) == [("a", 2, 1)]


def test_unknown_actor_is_dropped(events):
    rows = events((("e1"), None, "r", N), ("e2", "a", "r", N))
    assert found(user_sessions(rows, as_of=N)) == [("a", 1, 1)]


def test_limit_and_order(events):
    rows = events(*(row for actor in "edcba" for row in of(actor, minutes(0, 60))))
    limited = user_sessions(rows, limit=3, as_of=N)
    assert found(limited) == [("a", 2, 1), ("a", 1, 1), ("b", 2, 1)]
    assert user_sessions(rows, limit=50, as_of=N).count() == 10
    assert user_sessions(rows, limit=None, as_of=N).count() == 10


@pytest.mark.parametrize("bad", [{"days": -1}, {"limit": -10}, {"limit": 0}])
def test_invalid_parameters(events, bad):
    with pytest.raises(ValueError):
        user_sessions(events(), **bad)


def brute_force(rows, gap=timedelta(minutes=30)):
    """event id -> (sequence, previous time, flag, session id)"""
    result, per_actor = {}, {}
    for event_id, actor, _, at in sorted(rows, key=lambda r: (r[3], r[0])):
        sequence, before, session = per_actor.get(actor, (0, None, 0))
        new = int(before is None or at - before > gap)
        per_actor[actor] = (sequence + 1, at, session + new)
        result[event_id] = (sequence + 1, before, new, session + new)
    return result


@pytest.fixture(scope="module")
def mixed_rows():
    """One actor with most rows, ties in time, gaps around the limit."""
    random.seed(7)
    at, rows = datetime(2024, 3, 9, 12), []
    for i in range(600):
        at += timedelta(minutes=random.choice([0, 0, 1, 29, 30, 31, 45]))
        actor = random.choice(["hot", "hot", "hot", "b", "c"])
        rows.append((f"id{random.randrange(10**9)}-{i}", actor, "r", at))
    return rows


def test_steps_against_brute_force(events, any_zone, mixed_rows):
    result = sessionize(events(*mixed_rows))
    got = {
        r.event_id: (r.event_sequence, r.prev_created_at, r.is_new_session, r.session_id)
        for r in result.collect()
    }
    assert got == brute_force(mixed_rows)


def test_totals_against_brute_force(events, any_zone, mixed_rows):
    expected = {}
    steps = brute_force(mixed_rows)
    for event_id, actor, _, at in mixed_rows:
        expected.setdefault((actor, steps[event_id][3]), []).append(at)
    got = {
        (r.actor_login, r.session_id): (
            r.session_start_at,
            r.session_end_at,
            r.events_in_session,
        )
        for r in session_totals(events(*mixed_rows)).collect()
    }
    assert got == {k: (min(v), max(v), len(v)) for k, v in expected.items()}


def test_look_back_follows_the_gap(events):
    start = N - timedelta(days=7)
    rows = events(
        ("e1", "a", "r", start - timedelta(minutes=70)),
        ("e2", "a", "r", start + timedelta(minutes=40)),
    )
    (session,) = user_sessions(rows, as_of=N, gap="2 hours").collect()
    assert session.events_in_session == 2


@pytest.mark.parametrize("bound", [1000, 20, 3])
def test_a_busy_day_is_sorted_in_pieces(events, bound):
    """One actor's day over the bound, by hours and minutes, and days under it."""
    random.seed(bound)
    rows = [
        (f"e{i}", "busy", "r", N + timedelta(seconds=random.randrange(40) * 97 + (i % 3) * 86_400))
        for i in range(90)
    ]
    rows += [(f"x{i}", "calm", "r", N + timedelta(minutes=25 * i)) for i in range(6)]
    rows += [("n", "calm", "r", None), ("m", "calm", "r", None)]
    table = events(*rows)
    columns = ["event_id", "event_sequence", "prev_created_at", "is_new_session", "session_id"]
    got = sessionize(table, max_rows_per_run=bound).select(*columns).collect()
    whole = W.partitionBy("actor_login").orderBy("created_at", "event_id")
    before = F.lag("created_at").over(whole)
    new = before.isNull() | (F.col("created_at") - before > F.expr("INTERVAL 30 MINUTES"))
    expected = (
        table.withColumn("event_sequence", F.row_number().over(whole).cast("long"))
        .withColumn("prev_created_at", before)
        .withColumn("is_new_session", F.when(new, 1).otherwise(0))
        .withColumn("session_id", F.sum("is_new_session").over(whole))
        .filter("created_at IS NOT NULL")
    )
    timed = [r for r in got if r.event_id not in ("n", "m")]
    assert sorted(map(tuple, timed)) == sorted(map(tuple, expected.select(*columns).collect()))
    pieces = _slotted(table, bound).filter("actor_login = 'busy'").select("run_", "slot_").distinct()
    assert (pieces.count() == 3) == (bound == 1000)
