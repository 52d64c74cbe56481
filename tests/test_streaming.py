from datetime import datetime, timedelta

import pandas as pd
from conftest import N
from test_load import Folder
from test_parse import BROKEN, line

from logweir import land_events, read_events, read_manifest, stream_load, stream_sessions
from logweir.operators.sessions import session_totals
from logweir.plans import shared
from logweir.sources import id_index, loader
from logweir.sources.lake import compact_events
from logweir.streaming import file_loader
from logweir.streaming.numbered import LATE, SESSION, _Numbered, write_numbered_sessions


def run(folder, path, **options):
    query = stream_load(
        folder.spark, str(folder.raw), folder.lake, str(path / "checkpoint"), **options
    )
    query.awaitTermination()


def test_stream_load_equals_load(spark, tmp_path):
    batch, stream = (Folder(spark, tmp_path / n) for n in make(tmp_path, "batch", "stream"))
    for folder in (batch, stream):
        folder.write("a.jsonl", line(id="e1"), "", line(id="e2", type="A"))
        folder.write("b.jsonl", line(id="e2", type="B"), line(id="e3"))
        folder.write("c.jsonl", line(id="e4"), BROKEN)
    batch.load()
    run(stream, tmp_path)

    def content(folder):
        return {
            (r.event_id, r.event_type, r.source_file, r.raw) for r in folder.events().values()
        }

    assert content(stream) == content(batch)
    assert set(stream.manifest()) == {"a.jsonl", "b.jsonl"}


def make(tmp_path, *names):
    for name in names:
        (tmp_path / name).mkdir()
    return names


def test_stream_load_goes_on_and_repeats_safely(spark, tmp_path):
    folder = Folder(spark, tmp_path)
    folder.write("a.jsonl", line(id="e1"))
    run(folder, tmp_path)
    folder.write("b c.jsonl", line(id="e1"), line(id="e2"))
    run(folder, tmp_path, max_files_per_trigger=1)
    assert set(folder.events()) == {"e1", "e2"}
    # Without its own memory the stream sees all files again; the manifest knows.
    run(folder, tmp_path / "again")
    assert set(folder.events()) == {"e1", "e2"}
    assert len(folder.manifest()) == 2
    # Both ways of loading share it.
    assert folder.load() == (2, 0, 2, 0)


def test_stream_sessions_equal_batch(spark, events, tmp_path, any_zone):
    times = [0, 10, 40, 71, 101, 101, 300]
    start = datetime(2024, 3, 10, 0, 45)
    rows = [
        (f"{actor}{i}", actor, "r", start + timedelta(minutes=m))
        for actor in ("ann", "bob", None)
        for i, m in enumerate(times)
    ]
    frame = events(*rows)
    frame.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(frame.schema).parquet(str(tmp_path / "in"))
    query = (
        stream_sessions(stream)
        .writeStream.format("memory")
        .outputMode("complete")
        .queryName("streamed_sessions")
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    streamed = spark.table("streamed_sessions")
    batch = session_totals(frame).drop("session_id")
    assert streamed.columns == batch.columns
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, batch.collect()))
    assert batch.count() == 6


def test_append_mode_gives_final_sessions_once(spark, events, tmp_path):
    def put(name, *rows):
        events(*rows).coalesce(1).write.parquet(str(tmp_path / "in" / name))

    schema = events().schema
    out, memory = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def advance():
        stream = (
            spark.readStream.schema(schema)
            .option("recursiveFileLookup", "true")
            .parquet(str(tmp_path / "in"))
        )
        (
            stream_sessions(stream)
            .writeStream.format("parquet")
            .option("path", out)
            .option("checkpointLocation", memory)
            .trigger(availableNow=True)
            .start()
            .awaitTermination()
        )
        return sorted(r.events_in_session for r in spark.read.parquet(out).collect())

    put("one", ("e1", "ann", "r", N), ("e2", "ann", "r", N + timedelta(minutes=5)))
    assert advance() == []
    put("two", ("e3", "bob", "r", N + timedelta(hours=3)))
    assert advance() == [2]


def test_stream_sees_landed_files_and_any_name(spark, tmp_path):
    raw, lake = tmp_path / "raw {1}", str(tmp_path / "lake")
    raw.mkdir()
    names = ["e_{2,3}.jsonl", "e[b].jsonl", "x y%20+ü.jsonl"]
    for i, name in enumerate(names):
        (raw / name).write_text(line(id=f"e{i}") + "\n")
    source = spark.createDataFrame([(line(id="landed"),)], "value string")
    land_events(source, str(raw))
    stream_load(spark, str(raw), lake, str(tmp_path / "c")).awaitTermination()
    found = {r.event_id: r.source_file for r in read_events(spark, lake).collect()}
    assert [found[f"e{i}"] for i in range(3)] == names and "landed" in found
    assert set(names) < {r.file_path for r in read_manifest(spark, lake).collect()}


def test_mended_file_loads_when_the_stream_starts_again(spark, tmp_path):
    raw, lake, state = tmp_path / "raw", str(tmp_path / "lake"), str(tmp_path / "c")
    raw.mkdir()
    (raw / "a.jsonl").write_text("{broken\n")
    stream_load(spark, str(raw), lake, state).awaitTermination()
    assert read_events(spark, lake).count() == 0
    (raw / "a.jsonl").write_text(line(id="e1") + "\n")
    stream_load(spark, str(raw), lake, state).awaitTermination()
    assert [r.event_id for r in read_events(spark, lake).collect()] == ["e1"]
    stream_load(spark, str(raw), lake, state).awaitTermination()
    assert read_events(spark, lake).count() == 1


class Numbered:
    """A folder of events that is streamed a step at a time."""

    def __init__(self, spark, events, path):
        self.spark, self.events, self.path, self.schema = spark, events, path, events().schema

    def put(self, name, *rows):
        self.events(*rows).coalesce(1).write.parquet(str(self.path / "in" / name))

    def advance(self):
        stream = (
            self.spark.readStream.schema(self.schema)
            .option("recursiveFileLookup", "true")
            .parquet(str(self.path / "in"))
        )
        places = [str(self.path / name) for name in ("out", "late", "checkpoint")]
        write_numbered_sessions(stream, *places).awaitTermination()

    def read(self, name, columns):
        found = self.spark.read.option("mergeSchema", "true").parquet(str(self.path / name))
        return sorted(map(tuple, found.select(*columns).collect()))


def test_numbered_sessions_equal_batch_and_number_on(spark, events, tmp_path, any_zone):
    times = [0, 10, 40, 71, 101, 101, 300]
    start = datetime(2024, 3, 10, 0, 45)
    rows = [
        (f"{actor}{i}", actor, "r", start + timedelta(minutes=m))
        for actor in ("ann", "bob", None)
        for i, m in enumerate(times)
    ]
    folder = Numbered(spark, events, tmp_path)
    end = start + timedelta(minutes=2000)
    # An order within a micro-batch does not matter.
    folder.put("one", *rows[:4][::-1], *rows[7:11])
    folder.advance()
    folder.put("two", *rows[4:7], *rows[11:])
    folder.advance()
    folder.put("three", ("end", "zoe", "r", end))
    folder.advance()
    batch = session_totals(events(*rows)).select(*SESSION)
    assert folder.read("out", SESSION) == sorted(map(tuple, batch.collect()))
    assert folder.read("late", LATE) == []
    # Numbers go on after a long pause, and nothing comes out twice.
    folder.put("four", ("a8", "ann", "r", end), ("z9", "zoe", "r", end + timedelta(days=1)))
    folder.advance()
    assert [row[1] for row in folder.read("out", SESSION) if row[0] == "ann"] == [1, 2, 3, 4]
    assert [row[1] for row in folder.read("out", SESSION) if row[0] == "zoe"] == [1]


def test_late_rows_come_out_beside_and_change_nothing(spark, events, tmp_path):
    folder = Numbered(spark, events, tmp_path)
    folder.put("one", ("e1", "ann", "r", N), ("e2", "bob", "r", N + timedelta(hours=5)))
    folder.advance()
    assert [row[:2] for row in folder.read("out", SESSION)] == [("ann", 1)]
    # Older than the watermark, then at it, within the lateness, and without a time.
    mark = N + timedelta(hours=4, minutes=50)
    folder.put(
        "two",
        ("e3", "ann", "r", N + timedelta(minutes=1)),
        ("e4", "bob", "r", mark - timedelta(microseconds=1000)),
        ("e5", "bob", "r", mark),
        ("e6", "bob", "r", None),
        ("e7", "eve", "r", N + timedelta(days=1)),
    )
    folder.advance()
    late = folder.read("late", LATE)
    assert [row[1] for row in late] == ["e3", "e4"]
    assert late[0] == ("ann", "e3", N + timedelta(minutes=1))
    found = folder.read("out", SESSION)
    assert found == [
        ("ann", 1, N, N, 1),
        ("bob", 1, mark, N + timedelta(hours=5), 2),
    ]


def test_the_manifest_does_not_pass_the_driver_with_each_micro_batch(spark, tmp_path, monkeypatch):
    folder = Folder(spark, tmp_path)
    for i in range(6):
        folder.write(f"a{i}.jsonl", line(id=f"e{i}"))
    folder.load()
    sizes = []

    def counted(df):
        sizes.append(df.count())
        return broadcast(df)

    broadcast = file_loader.F.broadcast
    monkeypatch.setattr(file_loader.F, "broadcast", counted)
    columns = "path string, source_file string, file_size long"
    files = spark.createDataFrame([("p", "a1.jsonl", 1), ("q", "b.jsonl", 1)], columns)
    left = file_loader.not_known(files, read_manifest(spark, folder.lake))
    assert [r.source_file for r in left.collect()] == ["b.jsonl"]
    assert sizes == [2, 1]


class Counted:
    """An actor's handle that counts round trips: one state, and timers."""

    def __init__(self):
        self.calls, self.value, self.timers = 0, None, set()

    def getValueState(self, name, schema):
        return self

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.calls += 1
        self.value = value

    def registerTimer(self, moment):
        self.calls += 1
        self.timers.add(moment)

    def deleteTimer(self, moment):
        self.calls += 1
        self.timers.remove(moment)


class Mark:
    def __init__(self, millis):
        self.millis = millis

    def getCurrentWatermarkInMs(self):
        return self.millis


def test_an_actor_takes_few_round_trips(spark):
    handle, minute = Counted(), 60_000_000
    actor = _Numbered(30 * minute)
    actor.init(handle)

    def rows(*minutes):
        ats = [m * minute for m in minutes]
        return iter([pd.DataFrame({"event_id": list("abcdef")[: len(ats)], "at": ats})])

    def closed(frames):
        told = [f[["session_id", "first", "last", "events_in_session"]] for f in frames]
        return [tuple(x // minute if 0 < i < 3 else x for i, x in enumerate(r)) for f in told for r in f.to_numpy().tolist()]

    assert not list(actor.handleInputRows(("ann",), rows(0, 100, 10, 300), Mark(0)))
    assert handle.calls == 3 and handle.timers == {40 * 60_000 + 1}
    handle.calls = 0
    # An earlier first event moves the timer's session on.
    assert not list(actor.handleInputRows(("ann",), rows(35), Mark(0)))
    assert handle.calls == 4 and handle.timers == {65 * 60_000 + 1}
    handle.calls = 0
    came = handle.timers.pop()
    assert closed(actor.handleExpiredTimer(("ann",), Mark(200 * 60_000), came)) == [(1, 0, 35, 3), (2, 100, 100, 1)]
    assert handle.calls == 3 and handle.timers == {330 * 60_000 + 1}
    # A late row changes nothing, and nothing is stored for it.
    handle.calls = 0
    late = list(actor.handleInputRows(("ann",), rows(100), Mark(200 * 60_000)))
    assert [f["event_id"].tolist() for f in late] == [["a"]] and handle.calls == 1
    came = handle.timers.pop()
    assert closed(actor.handleExpiredTimer(("ann",), Mark(400 * 60_000), came)) == [(3, 300, 300, 1)]
    assert not handle.timers


def test_a_micro_batch_reads_ids_and_not_the_events_before(spark, tmp_path, monkeypatch):
    folder = Folder(spark, tmp_path)
    folder.write("a.jsonl", line(id="e1"), line(id="e2", type="A"))
    run(folder, tmp_path)
    folder.write("b.jsonl", line(id="e2", type="B"), line(id="e3"))
    folder.write("c.jsonl", line(id="e3", type="C"), line(id="e4"), BROKEN)

    def refused(*_):
        raise AssertionError("the events' files were listed")

    with monkeypatch.context() as patch:
        patch.setattr(id_index, "read_events", refused)
        run(folder, tmp_path, max_files_per_trigger=1)
    assert {(r.event_id, r.event_type) for r in folder.events().values()} == {
        ("e1", "PushEvent"),
        ("e2", "A"),
        ("e3", "PushEvent"),
    }
    assert set(folder.manifest()) == {"a.jsonl", "b.jsonl"}


def test_known_ids_of_every_kind_of_batch(spark, tmp_path, monkeypatch):
    folder = Folder(spark, tmp_path)

    def known():
        return sorted(r.event_id for r in id_index.known_ids(spark, folder.lake).collect())

    assert known() == []
    with monkeypatch.context() as patch:
        # A large load keeps no file of ids.
        patch.setattr(loader, "MAX_BROADCAST_ROWS", 0)
        folder.write("a.jsonl", line(id="large"))
        folder.load()
    assert known() == ["large"]
    folder.write("b.jsonl", line(id="small"))
    folder.load()
    assert known() == ["large", "small"]

    def crash(*_):
        raise OSError

    with monkeypatch.context() as patch:
        patch.setattr(loader, "commit_files", crash)
        folder.write("c.jsonl", line(id="never"))
        try:
            folder.load()
        except OSError:
            pass
    assert known() == ["large", "small"]
    assert compact_events(spark, folder.lake) == 2
    assert set(known()) == {"large", "small"}
    # What broke is loaded anew, and nothing twice.
    folder.write("d.jsonl", line(id="small"), line(id="large"), line(id="new"))
    run(folder, tmp_path)
    assert sorted(folder.events()) == ["large", "never", "new", "small"]
    assert read_events(spark, folder.lake).count() == 4


def test_a_micro_batch_of_known_and_new_and_blank_files(spark, tmp_path):
    folder = Folder(spark, tmp_path)
    folder.write("a.jsonl", line(id="e1"))
    folder.load()
    # The stream is offered the known file as well; its lines must not count again.
    folder.write("a.jsonl", line(id="e1"), line(id="changed"))
    folder.write("b c.jsonl", line(id="e2"))
    folder.write("blank.jsonl", "", "  ")
    run(folder, tmp_path)
    assert sorted(folder.events()) == ["e1", "e2"]
    assert set(folder.manifest()) == {"a.jsonl", "b c.jsonl", "blank.jsonl"}


def test_files_are_listed_by_few_tasks(spark, tmp_path):
    folder = Folder(spark, tmp_path)
    most, before = 4 * spark.sparkContext.defaultParallelism, spark.conf.get(shared.LISTING_TASKS)
    try:
        for given, kept in [("10000", str(most)), ("3", "3")]:
            spark.conf.set(shared.LISTING_TASKS, given)
            run(folder, tmp_path / given)
            assert spark.conf.get(shared.LISTING_TASKS) == kept
    finally:
        spark.conf.set(shared.LISTING_TASKS, before)


def test_landed_files_have_no_checksum_files(spark, tmp_path):
    source = spark.createDataFrame([(line(id=f"e{i}"),) for i in range(5)], "value string")
    folder = land_events(source.coalesce(1), str(tmp_path / "raw"), max_records=2)
    found = [p.name for p in (tmp_path / "raw").glob("landed_*/*")]
    assert len([name for name in found if name.startswith("part-")]) == 3
    assert not [name for name in found if name.endswith(".crc")]
    assert spark.read.text(folder).count() == 5
