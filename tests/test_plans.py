"""Shapes of physical plans that matter once the tables are large."""

import pytest
from test_parse import line

from logweir import (
    events_per_type,
    land_events,
    load_events,
    read_events,
    recent_repo_events,
    repo_events_nested,
    sessionize,
    top_repos,
    user_sessions,
)
from logweir.operators.loading import dedup_first, drop_existing
from logweir.sources.sample_tables import canonical_events

SF = "/root/testdata/sf0.001"
AS_OF = "2024-01-31"


@pytest.fixture
def table(spark):
    return canonical_events(spark, SF)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_user_sessions(table):
    text = plan(user_sessions(table, as_of=AS_OF))
    assert "GreaterThanOrEqual(ts,2024-01-23T23:30)" in text
    assert "props" not in text and "event_type" not in text
    # Slots, then actors; window and totals share the second.
    assert text.count("Exchange hashpartitioning") == 2
    # Slots are combined before they are shuffled.
    assert text.rindex("partial_min") > text.rindex("Exchange")
    assert "TakeOrderedAndProject" in text


def test_top_repos(table):
    text = plan(top_repos(table, as_of=AS_OF))
    assert "GreaterThan(ts,2024-01-01T00:00)" in text
    assert "TakeOrderedAndProject" in text
    # Repository with user first, so that a hot repository is spread.
    assert text.count("Exchange hashpartitioning(repo_name") == 2
    assert "partial_count" in text


def test_steps_run_by_actor_and_day(table):
    text = plan(sessionize(table))
    # The events' own shuffle, by actor and day, twice in the text.
    assert text.count("Exchange hashpartitioning(actor_login") >= 2
    assert "SinglePartition" not in text


def test_nested_reads_what_it_needs(table):
    text = plan(repo_events_nested(table, 1))
    assert "SinglePartition" not in text
    assert "partial_count" in text
    assert "value" not in text.split("ReadSchema")[1]


def test_small_queries_combine_before_the_shuffle(table):
    assert "partial_count" in plan(events_per_type(table))
    assert "TakeOrderedAndProject" in plan(recent_repo_events(table, "org/repo7"))


def test_dedup_combines_before_the_shuffle(spark):
    parsed = spark.range(10).selectExpr(
        "CAST(id AS STRING) AS event_id",
        "'f' AS source_file",
        "0L AS block_start",
        "id AS line",
        "'text' AS raw",
    )
    text = plan(dedup_first(parsed))
    assert "Window" not in text
    assert text.rindex("partial_min") > text.rindex("Exchange")


def test_small_load_never_shuffles_the_stored_side(spark, table):
    new = table.limit(5).select("event_id")
    text = plan(drop_existing(new, table, 5))
    assert text.count("BroadcastHashJoin") == 2
    assert "Exchange hashpartitioning" not in text
    large = plan(drop_existing(new.hint("merge"), table, 10**9))
    assert "LeftAnti" in large and "BroadcastHashJoin" not in large


@pytest.mark.parametrize("word", ["CartesianProduct", "BroadcastNestedLoopJoin", "Python"])
def test_no_slow_operators(table, word):
    for df in [
        user_sessions(table, as_of=AS_OF),
        top_repos(table, as_of=AS_OF),
        sessionize(table),
        repo_events_nested(table),
    ]:
        assert word not in plan(df)


def test_events_of_a_batch_are_not_gathered(spark, tmp_path):
    """Joined by hash, all events of a batch would go to one task."""
    lake = str(tmp_path / "lake")
    land_events(spark.createDataFrame([(line(id="e1"),)], "value string"), str(tmp_path / "raw"))
    load_events(spark, str(tmp_path / "raw"), lake, views=False)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(read_events(spark, lake))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin [batch_id" in text
    assert "SortMergeJoin [batch_id" in text  # what is committed, on its own few rows
    assert text.index("BroadcastHashJoin") < text.index("SortMergeJoin")
