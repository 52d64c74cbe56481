from logweir.operators.explore import (
    event_count,
    events_per_hour,
    events_per_type,
    most_active_users,
    recent_repo_events,
    repo_counts,
)
from logweir.operators.nested import (
    create_views,
    repo_events_nested,
    repo_events_nested_parts,
)
from logweir.operators.repos import top_repos
from logweir.operators.sessions import sessionize, user_sessions

__all__ = [
    "create_views",
    "event_count",
    "events_per_hour",
    "events_per_type",
    "most_active_users",
    "recent_repo_events",
    "repo_counts",
    "repo_events_nested",
    "repo_events_nested_parts",
    "sessionize",
    "top_repos",
    "user_sessions",
]
