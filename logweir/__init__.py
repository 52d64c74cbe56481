"""Landing, loading and analysing activity-event logs on Spark."""

from logweir.operators import (
    create_views,
    event_count,
    events_per_hour,
    events_per_type,
    most_active_users,
    recent_repo_events,
    repo_counts,
    repo_events_nested,
    repo_events_nested_parts,
    sessionize,
    top_repos,
    user_sessions,
)
from logweir.session import build_session
from logweir.sources import (
    LoadResult,
    land_events,
    load_events,
    read_events,
    read_manifest,
)
from logweir.streaming import (
    numbered_sessions,
    stream_load,
    stream_sessions,
    write_numbered_sessions,
)

__all__ = [
    "LoadResult",
    "build_session",
    "create_views",
    "event_count",
    "events_per_hour",
    "events_per_type",
    "land_events",
    "load_events",
    "most_active_users",
    "numbered_sessions",
    "read_events",
    "read_manifest",
    "recent_repo_events",
    "repo_counts",
    "repo_events_nested",
    "repo_events_nested_parts",
    "sessionize",
    "stream_load",
    "stream_sessions",
    "top_repos",
    "user_sessions",
    "write_numbered_sessions",
]
