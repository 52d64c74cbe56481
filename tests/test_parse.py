import json
from datetime import datetime

import pytest

from logweir.operators.loading import (
    classify_files,
    dedup_first,
    drop_existing,
    failed_files,
    latest_by,
    parse_lines,
)

T = "2026-02-03T10:35:16Z"
WHOLE = {"id": "1", "type": "PushEvent", "created_at": T, "_ingested_at": T}


def line(**changes):
    return json.dumps({**WHOLE, **changes})


def lines(spark, rows):
    """(file, text) pairs, in order."""
    return spark.createDataFrame(
        [(file, 0, i, text) for i, (file, text) in enumerate(rows)],
        "source_file string, block_start long, line long, value string",
    )


def parsed_all(spark, texts):
    """The parsed rows, in order of the given lines."""
    rows = parse_lines(lines(spark, [("f", text) for text in texts])).collect()
    return sorted(rows, key=lambda row: row.line)


def parsed_one(spark, text):
    return parsed_all(spark, [text])[0]


def test_fields(spark, any_zone):
    text = line(
        created_at="2026-02-03T10:35:16.421955Z",
        actor={"id": 12, "login": "ann"},
        repo={"id": "34", "name": "org/a"},
        payload={"size": 1, "list": ["é"]},
        public=True,
    )
    row = parsed_one(spark, f"  {text}\t")
    assert row.status == "ok"
    assert (row.event_id, row.event_type) == ("1", "PushEvent")
    assert row.created_at == datetime(2026, 2, 3, 10, 35, 16, 421955)
    assert row.ingested_at == datetime(2026, 2, 3, 10, 35, 16)
    assert (row.actor_id, row.actor_login) == (12, "ann")
    assert (row.repo_id, row.repo_name) == (34, "org/a")
    assert json.loads(row.payload) == {"size": 1, "list": ["é"]}
    assert row.raw == text


def test_time_skipped_by_the_session_zone(spark, any_zone):
    row = parsed_one(spark, line(created_at="2024-03-10T02:30:00Z"))
    assert row.created_at == datetime(2024, 3, 10, 2, 30)


def test_fatal(spark):
    texts = [
        "{",
        line()[:-1],
        f"[{line()}]",
        "5",
        '"text"',
        "null",
        line() + " trailing",
        line() + line(),
        f"{line()},{line()}",
        line() + "]",
        line() + "],[",
        line().replace('"', "'"),
        line(actor=None),
        line(repo=None),
        line(actor="ann"),
        line(actor=[]),
        line(repo=[{"id": 1}]),
        line(id="a\tb").replace("\\t", "\t"),
    ]
    passed = [r.raw for r in parsed_all(spark, texts) if r.status != "fatal"]
    assert passed == []


def test_violating(spark):
    texts = [
        "{}",
        line(id=None),
        line(type=None),
        line(created_at=None),
        line(created_at=""),
        line(created_at="yesterday"),
        line(created_at=2024),
        line(created_at="2024-05"),
        json.dumps({k: v for k, v in WHOLE.items() if k != "_ingested_at"}),
        line(actor={"id": 2**31}),
        line(repo={"id": "many"}),
    ]
    others = [r.raw for r in parsed_all(spark, texts) if r.status != "violating"]
    assert others == []


def test_ok(spark):
    expected = [
        (line(), "1"),
        (line(id=77), "77"),
        (line(actor={}, repo={"name": None}), "1"),
        (line(actor={"id": "12"}), "1"),
        # Of equal keys the last one counts.
        (line()[:-1] + ', "id": "2"}', "2"),
    ]
    rows = parsed_all(spark, [text for text, _ in expected])
    assert [(r.status, r.event_id) for r in rows] == [("ok", i) for _, i in expected]


def test_payload(spark):
    cases = [
        ({}, None),
        ([], None),
        ("", None),
        (0, None),
        (0.0, None),
        (-0.0, None),
        (False, None),
        (None, None),
        ({"a": {}}, {"a": {}}),
        ([0], [0]),
        ("0", "0"),
        ("false", "false"),
        ("text", "text"),
        (True, True),
        (7, 7),
        (1.5, 1.5),
    ]
    rows = parsed_all(spark, [line(payload=payload) for payload, _ in cases])
    got = [r.payload and json.loads(r.payload) for r in rows]
    assert got == [expected for _, expected in cases]


def test_missing_payload(spark):
    assert parsed_one(spark, line()).payload is None


def failing(spark, rows, stored=()):
    table = spark.createDataFrame([(i,) for i in stored], "event_id string")
    return {r[0] for r in failed_files(parse_lines(lines(spark, rows)), table).collect()}


BROKEN = "{"


def late(event_id):
    """A violating line that still has an id."""
    return line(id=event_id, created_at=None)


def test_failed_files(spark):
    rows = [("a", line()), ("b", line(id="2")), ("b", BROKEN), ("c", late("3"))]
    assert failing(spark, rows) == {"b", "c"}
    assert failing(spark, rows, stored=["3"]) == {"b"}
    assert failing(spark, [("a", line())]) == set()


def test_violation_without_id_fails(spark):
    assert failing(spark, [("a", line(id=None))]) == {"a"}


def test_violation_excused_by_an_earlier_line(spark):
    assert failing(spark, [("a", line(id="x")), ("a", late("x"))]) == set()
    assert failing(spark, [("a", late("x")), ("a", line(id="x"))]) == {"a"}
    assert failing(spark, [("a", line(id="x")), ("b", late("x"))]) == set()
    # By file name, not by order of reading.
    assert failing(spark, [("b", line(id="x")), ("a", late("x"))]) == {"a"}


def test_excuse_from_a_failed_file_does_not_count(spark):
    chain = [
        ("a", line(id="x")),
        ("a", BROKEN),
        ("b", late("x")),
        ("b", line(id="y")),
        ("c", late("y")),
        ("c", line(id="z")),
        ("d", late("z")),
    ]
    assert failing(spark, chain) == {"a", "b", "c", "d"}
    assert failing(spark, chain[:1] + chain[2:]) == set()
    # One good source is enough.
    assert failing(spark, chain + [("aa", line(id="y"))]) == {"a", "b"}


def test_dedup_first(spark):
    rows = [
        ("b.jsonl", line(id="1", type="later file")),
        ("a.jsonl", line(id="1", type="first")),
        ("a.jsonl", line(id="1", type="later line")),
        ("b.jsonl", line(id="2", type="only")),
    ]
    result = dedup_first(parse_lines(lines(spark, rows)))
    assert {r.event_id: (r.source_file, r.event_type) for r in result.collect()} == {
        "1": ("a.jsonl", "first"),
        "2": ("b.jsonl", "only"),
    }


@pytest.mark.parametrize("new_rows", [None, 3, 10**9])
def test_drop_existing(spark, new_rows):
    new = spark.createDataFrame([("1", 5), ("2", 6), ("3", 7)], "event_id string, v int")
    stored = spark.createDataFrame([("2", 0), ("9", 0)], "event_id string, w int")
    result = drop_existing(new, stored, new_rows)
    assert sorted(tuple(r) for r in result.collect()) == [("1", 5), ("3", 7)]


def test_classify_and_report(spark):
    schema = "file_path string, file_sha256 string"
    files = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3")], schema)
    manifest = spark.createDataFrame([("a", "1"), ("b", "x"), ("gone", "y")], schema)
    classified = classify_files(files, manifest)
    assert {r.file_path: r.status for r in classified.collect()} == {
        "a": "unchanged",
        "b": "modified",
        "c": "new",
    }


def test_latest_by(spark):
    rows = spark.createDataFrame(
        [("a", 1, "old"), ("a", 2, "new"), ("b", 1, "only")], "k string, at int, v string"
    )
    assert {tuple(r) for r in latest_by(rows, "k", "at").collect()} == {
        ("a", 2, "new"),
        ("b", 1, "only"),
    }
