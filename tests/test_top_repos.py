from datetime import timedelta

import pytest
from conftest import N

from logweir import top_repos

COLUMNS = [
    "repo_name",
    "total_events",
    "unique_users",
    "push_events",
    "first_event_at",
    "last_event_at",
    "processed_at",
]


def test_empty_keeps_columns(events):
    result = top_repos(events(), as_of=N)
    assert result.columns == COLUMNS
    assert result.collect() == []


def test_counts_users_pushes_and_times(events, any_zone):
    result = top_repos(
        events(
            ("e1", "ann", "org/a", N - timedelta(hours=3)),
            ("e2", "ann", "org/a", N - timedelta(hours=1)),
            ("e3", "bob", "org/a", N - timedelta(hours=2), "CreateEvent"),
            ("e4", None, "org/a", N - timedelta(hours=2), "CreateEvent"),
        ),
        as_of=N,
    ).collect()
    (row,) = result
    assert (row.total_events, row.unique_users, row.push_events) == (4, 2, 2)
    assert row.first_event_at == N - timedelta(hours=3)
    assert row.last_event_at == N - timedelta(hours=1)
    assert row.processed_at is not None


def test_days(events):
    rows = events(
        ("old", "ann", "org/old", N - timedelta(days=60)),
        ("new", "ann", "org/new", N),
    )
    assert [r.repo_name for r in top_repos(rows, days=30, as_of=N).collect()] == ["org/new"]
    assert top_repos(rows, days=90, as_of=N).count() == 2


def test_start_is_excluded_and_future_included(events, any_zone):
    start = N - timedelta(days=30)
    rows = events(
        ("e1", "a", "org/at", start),
        ("e2", "a", "org/after", start + timedelta(microseconds=1)),
        ("e3", "a", "org/future", N + timedelta(days=5)),
    )
    names = {r.repo_name for r in top_repos(rows, as_of=N).collect()}
    assert names == {"org/after", "org/future"}


def test_limit_and_ties_by_name(events):
    rows = events(
        *((f"{repo}{i}", "a", f"org/{repo}", N) for repo in "dcbea" for i in range(3))
    )
    assert [r.repo_name for r in top_repos(rows, limit=2, as_of=N).collect()] == [
        "org/a",
        "org/b",
    ]
    assert top_repos(rows, limit=10, as_of=N).count() == 5


def test_null_repo_is_a_group(events):
    rows = events(("e1", "a", None, N), ("e2", "a", None, N), ("e3", "a", "org/a", N))
    assert [(r.repo_name, r.total_events) for r in top_repos(rows, as_of=N).collect()] == [
        (None, 2),
        ("org/a", 1),
    ]


@pytest.mark.parametrize("bad", [{"days": -1}, {"days": 0}, {"limit": -5}, {"limit": 0}])
def test_invalid_parameters(events, bad):
    with pytest.raises(ValueError):
        top_repos(events(), **bad)


def test_other_push_type(events):
    rows = events(("e1", "a", "r", N, "buy"), ("e2", "a", "r", N))
    assert top_repos(rows, as_of=N, push_type="buy").first().push_events == 1
