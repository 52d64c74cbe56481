import sys
from datetime import datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from logweir import build_session  # noqa: E402

N = datetime(2026, 2, 10)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(params=["UTC", "America/New_York"])
def any_zone(request, spark):
    """Run in a session zone that is not UTC as well."""
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.fixture
def events(spark):
    """Build an events frame from (id, actor, repo, time[, type]) tuples."""

    def build(*rows):
        return spark.createDataFrame(
            [
                (row[0], row[4] if len(row) > 4 else "PushEvent", row[3], row[1], 100, row[2])
                for row in rows
            ],
            "event_id string, event_type string, created_at timestamp_ntz, "
            "actor_login string, repo_id int, repo_name string",
        )

    return build
