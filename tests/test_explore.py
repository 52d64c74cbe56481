from datetime import datetime, timedelta

import pytest
from conftest import N

from logweir import (
    event_count,
    events_per_hour,
    events_per_type,
    most_active_users,
    recent_repo_events,
    repo_counts,
)


@pytest.fixture
def some(events):
    return events(
        ("e1", "ann", "org/a", N),
        ("e2", "ann", "org/a", N + timedelta(minutes=59), "IssuesEvent"),
        ("e3", "bob", "org/b", N + timedelta(minutes=60)),
        ("e4", None, None, N + timedelta(hours=9)),
    )


def test_event_count(some):
    assert event_count(some).first()[0] == 4


def test_events_per_type(some):
    assert [tuple(r) for r in events_per_type(some).collect()] == [
        ("PushEvent", 3),
        ("IssuesEvent", 1),
    ]


def test_counts_leave_out_null_keys(some):
    assert [tuple(r) for r in repo_counts(some).collect()] == [("org/a", 2), ("org/b", 1)]
    assert [tuple(r) for r in most_active_users(some, limit=1).collect()] == [("ann", 2)]


def test_events_per_hour(some, any_zone):
    assert [tuple(r) for r in events_per_hour(some, limit=2).collect()] == [
        (N + timedelta(hours=9), 1),
        (N + timedelta(hours=1), 1),
    ]


def test_hour_skipped_by_the_session_zone(events, any_zone):
    at = datetime(2024, 3, 10, 2, 30)
    (row,) = events_per_hour(events(("e", "a", "r", at))).collect()
    assert row.hour == datetime(2024, 3, 10, 2)


def test_recent_repo_events(some):
    result = recent_repo_events(some, "org/a", limit=5)
    assert result.columns == ["event_id", "event_type", "actor_login", "created_at"]
    assert [r.event_id for r in result.collect()] == ["e2", "e1"]
    assert recent_repo_events(some, "org/none").collect() == []


@pytest.mark.parametrize("query", [repo_counts, most_active_users, events_per_hour])
def test_limits_are_checked(some, query):
    with pytest.raises(ValueError):
        query(some, limit=0)
