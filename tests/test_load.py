import hashlib
import json
import logging
import os
import shutil
from datetime import datetime

import pytest
from test_parse import BROKEN, T, line

import logweir.sources.loader as loader
from logweir import (
    land_events,
    load_events,
    read_events,
    read_manifest,
    repo_events_nested,
    user_sessions,
)
from logweir.functions.jsonlines import split_response
from logweir.schemas import EVENTS, LOADED_FILES
from logweir.sources import id_index, lake, landed, rawfiles
from logweir.sources.lake import read_rejected


class Folder:
    def __init__(self, spark, path):
        self.spark, self.raw, self.lake = spark, path / "raw", str(path / "lake")
        self.raw.mkdir()

    def write(self, name, *texts):
        (self.raw / name).write_text("\n".join(texts) + "\n", encoding="utf-8")

    def load(self, **options):
        result = load_events(self.spark, str(self.raw), self.lake, **options)
        assert result.location == self.lake and result.duration_ms >= 0
        return (
            result.scanned_files,
            result.loaded_files,
            result.skipped_files,
            result.inserted_events,
        )

    def events(self):
        return {r.event_id: r for r in read_events(self.spark, self.lake).collect()}

    def manifest(self):
        return {r.file_path: r for r in read_manifest(self.spark, self.lake).collect()}


@pytest.fixture
def folder(spark, tmp_path):
    return Folder(spark, tmp_path)


def test_no_raw_folder(spark, tmp_path):
    result = load_events(spark, str(tmp_path / "none"), str(tmp_path / "lake"))
    assert (result.scanned_files, result.inserted_events) == (0, 0)
    events = read_events(spark, str(tmp_path / "lake"))
    assert events.columns[: len(EVENTS)] == EVENTS.fieldNames()
    assert events.count() == 0
    assert user_sessions(events).count() == 0


def test_load_twice(folder):
    folder.write(
        "a.jsonl",
        line(id="e1", actor={"id": 1, "login": "alice"}),
        line(id="e2", type="CreateEvent"),
        line(id="e3", type="IssuesEvent"),
    )
    assert folder.load() == (1, 1, 0, 3)
    assert folder.load() == (1, 0, 1, 0)
    assert len(folder.events()) == 3


def test_stored_columns(folder, any_zone):
    text = line(id="e1", repo={"id": 5, "name": "org/a"}, extra={"kept": [1]})
    folder.write("a.jsonl", text)
    folder.load(load_ts="2026-02-05T01:02:03")
    row = folder.events()["e1"]
    assert row.raw == text and row.source_file == "a.jsonl"
    assert row.loaded_at == datetime(2026, 2, 5, 1, 2, 3)
    assert row.created_at == datetime(2026, 2, 3, 10, 35, 16)
    assert (row.actor_id, row.repo_id, row.payload) == (None, 5, None)


def test_manifest_row(folder, any_zone):
    folder.write("a.jsonl", line())
    path = folder.raw / "a.jsonl"
    os.utime(path, (1710052200.5, 1710052200.5))
    folder.load(load_ts="2026-02-05")
    row = folder.manifest()["a.jsonl"]
    assert row.asDict().keys() == set(LOADED_FILES.fieldNames())
    assert row.file_size == path.stat().st_size
    assert row.file_mtime == datetime(2024, 3, 10, 6, 30, 0, 500000)
    assert row.file_sha256 == hashlib.sha256(path.read_bytes()).hexdigest()
    assert row.loaded_at == datetime(2026, 2, 5)


def test_same_event_in_two_files(folder):
    folder.write("b.jsonl", line(id="e2", type="B"), line(id="e3"))
    folder.write("a.jsonl", line(id="e1"), line(id="e2", type="A"))
    assert folder.load() == (2, 2, 0, 3)
    assert folder.events()["e2"].source_file == "a.jsonl"


@pytest.mark.parametrize("options", [{}, {"max_batch_files": 1}, {"max_batch_bytes": 1}])
def test_same_event_across_commits(folder, options):
    for i, name in enumerate("cab"):
        folder.write(f"{name}.jsonl", line(id="same"), line(id=f"own{i}"))
    assert folder.load(**options) == (3, 3, 0, 4)
    assert folder.events()["same"].source_file == "a.jsonl"
    assert len(folder.manifest()) == 3


def test_file_with_nothing_new_is_recorded(folder):
    folder.write("a.jsonl", line(id="e1"))
    folder.load()
    folder.write("b.jsonl", line(id="e1", type="Other"))
    assert folder.load() == (2, 1, 1, 0)
    assert folder.load() == (2, 0, 2, 0)
    assert folder.events()["e1"].event_type == "PushEvent"


def test_blank_lines(folder):
    folder.write("a.jsonl", "", " \t ", line(), "")
    folder.write("b.jsonl", "", " ")
    assert folder.load() == (2, 2, 0, 1)


def test_file_without_a_byte_is_counted_and_recorded(folder):
    (folder.raw / "a b.jsonl").write_text("")
    assert folder.load() == (1, 1, 0, 0)
    row = folder.manifest()["a b.jsonl"]
    assert row.file_size == 0 and row.file_sha256 == hashlib.sha256(b"").hexdigest()
    folder.write("c.jsonl", line(id="e1"))
    assert folder.load() == (2, 1, 1, 1)


NAMES = [
    "events_1.jsonl", "events_2.jsonl", "events_{2,3}.jsonl", "events_[b].jsonl", "a*.jsonl",
    "q?.jsonl", "x y.jsonl", "x!y.jsonl", "p%20q.jsonl", "1+1.jsonl", "grün é.jsonl",
]


def test_any_file_name(folder):
    for i, name in enumerate(NAMES):
        folder.write(name, line(id=f"e{i}"), line(id="same"))
    assert folder.load() == (len(NAMES), len(NAMES), 0, len(NAMES) + 1)
    assert set(folder.manifest()) == set(NAMES)
    events = folder.events()
    assert [events[f"e{i}"].source_file for i in range(len(NAMES))] == NAMES
    assert events["same"].source_file == min(NAMES)
    for name, row in folder.manifest().items():
        content = (folder.raw / name).read_bytes()
        assert row.file_sha256 == hashlib.sha256(content).hexdigest()
    assert folder.load() == (len(NAMES), 0, len(NAMES), 0)


def test_refused_files_are_all_recorded(folder):
    for i in range(25):
        folder.write(f"f{i:02d}.jsonl", BROKEN)
    assert folder.load() == (25, 0, 0, 0)
    refused = read_rejected(folder.spark, folder.lake).collect()
    assert sorted(r.file_path for r in refused) == [f"f{i:02d}.jsonl" for i in range(25)]
    assert {r.reason for r in refused} == {loader.INVALID}


def test_only_jsonl_and_no_subfolders(folder):
    folder.write("a.jsonl", line(id="e1"))
    folder.write("a.json", line(id="e2"))
    (folder.raw / "sub").mkdir()
    folder.write("sub/b.jsonl", line(id="e3"))
    assert folder.load() == (1, 1, 0, 1)


def test_failing_file_adds_nothing_and_is_tried_again(folder, caplog):
    folder.write("a.jsonl", line(id="e1"), BROKEN, line(id="e2"))
    folder.write("b.jsonl", line(id="e3"), line(id="e2"))
    folder.write("c.jsonl", line(id="e4"), line(id=None))
    with caplog.at_level(logging.WARNING):
        assert folder.load() == (3, 1, 0, 2)
    assert "a.jsonl" in caplog.text and "c.jsonl" in caplog.text
    assert set(folder.events()) == {"e2", "e3"}
    assert folder.events()["e2"].source_file == "b.jsonl"
    assert set(folder.manifest()) == {"b.jsonl"}
    folder.write("a.jsonl", line(id="e1"), line(id="e2"))
    assert folder.load() == (3, 1, 1, 1)
    assert set(folder.events()) == {"e1", "e2", "e3"}


def test_all_files_fail(folder):
    folder.write("a.jsonl", BROKEN)
    assert folder.load() == (1, 0, 0, 0)
    assert folder.manifest() == {} and folder.events() == {}


def test_violation_of_a_stored_event_is_passed_over(folder):
    folder.write("a.jsonl", line(id="e1"))
    folder.load()
    folder.write("b.jsonl", line(id="e1", created_at=None), line(id="e2"))
    assert folder.load() == (2, 1, 1, 1)


def test_modified_file_is_skipped_with_a_warning(folder, caplog):
    folder.write("a.jsonl", line(id="e1"))
    folder.load()
    before = folder.manifest()
    folder.write("a.jsonl", line(id="e1"), line(id="e2"))
    with caplog.at_level(logging.WARNING):
        assert folder.load() == (1, 0, 1, 0)
    assert "modified" in caplog.text and "a.jsonl" in caplog.text
    assert folder.manifest() == before and set(folder.events()) == {"e1"}


def test_touched_file_is_no_modification(folder, caplog):
    folder.write("a.jsonl", line(id="e1"))
    folder.load()
    os.utime(folder.raw / "a.jsonl", (1, 1))
    with caplog.at_level(logging.WARNING):
        assert folder.load() == (1, 0, 1, 0)
    assert "modified" not in caplog.text


def test_verify_known_sees_what_the_listing_hides(folder, caplog):
    folder.write("a.jsonl", line(id="e1"))
    os.utime(folder.raw / "a.jsonl", (1000, 1000))
    folder.load()
    folder.write("a.jsonl", line(id="e2"))
    os.utime(folder.raw / "a.jsonl", (1000, 1000))
    with caplog.at_level(logging.WARNING):
        folder.load()
        assert "modified" not in caplog.text
        assert folder.load(verify_known=True) == (1, 0, 1, 0)
    assert "modified" in caplog.text


def test_broken_load_leaves_nothing_visible(folder, monkeypatch):
    folder.write("a.jsonl", line(id="e1"), line(id="e2"))

    def crash(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(loader, "commit_files", crash)
        with pytest.raises(RuntimeError):
            folder.load()
    assert folder.events() == {} and folder.manifest() == {}
    assert folder.load() == (1, 1, 0, 2)
    assert len(folder.events()) == 2


def test_many_days_prune_by_partition(folder):
    folder.write(
        "a.jsonl",
        *(line(id=str(d), created_at=f"2026-01-{d:02d}T23:59:59Z",
               actor={"id": d, "login": "ann"}) for d in range(1, 29)),
    )
    folder.load()
    events = read_events(folder.spark, folder.lake)
    recent = user_sessions(events, days=7, as_of="2026-01-28T23:59:59")
    assert recent.count() == 8
    plan = recent._jdf.queryExecution().toString()
    assert "created_date#" in plan.split("PartitionFilters: ")[1].split("]")[0]


def test_views_after_a_load(folder):
    folder.write("a.jsonl", line(id="e1", repo={"id": 1, "name": "org/a"}))
    folder.load()
    row = folder.spark.sql("SELECT events[0].repo_id FROM repo_events_nested").first()
    assert row[0] == 1
    assert repo_events_nested(folder.spark.table("events")).count() == 1
    counted = folder.spark.sql(
        "SELECT count(*) FROM events WHERE repo_name = ? AND created_at >= ?",
        args=["org/a", datetime(2026, 1, 1)],
    )
    assert counted.first()[0] == 1
    files = folder.spark.sql("SELECT file_path FROM loaded_files")
    assert files.first().file_path == "a.jsonl"


def test_large_file_fingerprint(spark, tmp_path, monkeypatch):
    folder = Folder(spark, tmp_path)
    folder.write("a [1].jsonl", *(line(id=str(i)) for i in range(50)))
    folder.write("c.jsonl", line(id="other"))
    files = rawfiles.list_files(spark, str(folder.raw)).collect()
    exact = {r.file_path: r for r in rawfiles.fingerprints(spark, files).collect()}
    monkeypatch.setattr(rawfiles, "MAX_HASH_BYTES", 1000)
    monkeypatch.setattr(rawfiles, "PIECE", 100)
    assert {r.file_path: r for r in rawfiles.fingerprints(spark, files).collect()} == exact
    content = (folder.raw / "a [1].jsonl").read_bytes()
    assert exact["a [1].jsonl"].file_sha256 == hashlib.sha256(content).hexdigest()


def test_line_order_in_a_file_cut_into_blocks(folder):
    texts = [line(id=f"e{i % 400}", type=f"T{i}") for i in range(2000)]
    folder.write("a.jsonl", *texts)
    folder.spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    folder.spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        assert folder.load() == (1, 1, 0, 400)
    finally:
        folder.spark.conf.unset("spark.sql.files.maxPartitionBytes")
        folder.spark.conf.unset("spark.sql.files.openCostInBytes")
    assert {r.event_type for r in folder.events().values()} == {f"T{i}" for i in range(400)}


# --- folders, compaction, id index ------------------------------------------------


@pytest.mark.parametrize("name", ["a[b]", "x{1,2} y?*"])
def test_any_folder_name(spark, tmp_path, name):
    for other in ("ab", "x1 yab"):
        (tmp_path / other).mkdir()
        (tmp_path / other / "f.jsonl").write_text(line(id=f"foreign {other}") + "\n")
    raw, lake = tmp_path / name, str(tmp_path / f"lake {name}")
    raw.mkdir()
    (raw / "1 [b].jsonl").write_text(line(id="e1") + "\n")
    (raw / "none.jsonl").write_text("")
    land_events(texts_of(spark, line(id="e2")).coalesce(1), str(raw))
    for expected in [(3, 3, 0, 2), (3, 0, 3, 0)]:
        got = load_events(spark, str(raw), lake)
        counts = (got.scanned_files, got.loaded_files, got.skipped_files, got.inserted_events)
        assert counts == expected
    assert {r.event_id for r in read_events(spark, lake).collect()} == {"e1", "e2"}


def test_an_empty_file_is_found_without_listing_the_others(folder, monkeypatch):
    for i in range(5):
        folder.write(f"f{i}.jsonl", line(id=str(i)))
    (folder.raw / "none %20.jsonl").write_text("")
    listed = {r.file_path: r.file_size for r in rawfiles.list_files(folder.spark, str(folder.raw)).collect()}
    assert len(listed) == 6 and listed["none %20.jsonl"] == 0


def test_folders_loaded_whole_are_not_listed_again(folder, monkeypatch):
    listed = []

    def count(spark, raw_dir, folders=None):
        listing = rawfiles.list_files(spark, raw_dir, folders)
        listed.append(listing.count())
        return listing

    monkeypatch.setattr(loader, "list_files", count)
    for start in (0, 10):
        rows = [line(id=f"e{start + i}") for i in range(4)]
        where = land_events(texts_of(folder.spark, *rows).coalesce(1), str(folder.raw), max_records=1)
    folder.write("own.jsonl", line(id="own"))
    assert folder.load() == (9, 9, 0, 9) and listed.pop() == 9
    ledger = landed.read_ledger(folder.spark, folder.lake)
    assert sorted(row.files for row in ledger.collect()) == [4, 4]
    assert folder.load() == (9, 0, 9, 0) and listed.pop() == 1
    # A new folder is listed alone; one with a refused file again and again.
    bad = land_events(texts_of(folder.spark, line(id="e20")).coalesce(1), str(folder.raw))
    with open(os.path.join(bad, "part-broken.txt"), "w") as file:
        file.write(BROKEN + "\n")
    assert folder.load() == (11, 1, 9, 1) and listed.pop() == 3
    assert folder.load() == (11, 0, 10, 0) and listed.pop() == 3
    with open(os.path.join(bad, "part-broken.txt"), "w") as file:
        file.write(line(id="e21") + "\n")
    assert folder.load() == (11, 1, 10, 1) and listed.pop() == 3
    assert folder.load(verify_known=True) == (11, 0, 11, 0) and listed.pop() == 11
    assert folder.load() == (11, 0, 11, 0) and listed.pop() == 1
    # A folder that is gone no longer counts; one still being written is not entered.
    shutil.rmtree(where)
    unfinished = land_events(texts_of(folder.spark, line(id="e30")).coalesce(1), str(folder.raw))
    os.remove(os.path.join(unfinished, "_SUCCESS"))
    assert folder.load() == (8, 1, 7, 1) and listed.pop() == 2
    with open(os.path.join(unfinished, "part-more.txt"), "w") as file:
        file.write(line(id="e31") + "\n")
    assert folder.load() == (9, 1, 8, 1) and listed.pop() == 3


def stored_ids(folder):
    return sorted(r.event_id for r in read_events(folder.spark, folder.lake).collect())


def load_many(folder, count):
    for i in range(count):
        folder.write(f"f{i}.jsonl", line(id=f"e{i}"), line(id="same"))
        folder.load()


def test_compaction_replaces_batches_at_once(folder, monkeypatch):
    load_many(folder, 3)
    before = {r.event_id: r.asDict() for r in folder.events().values()}
    for row in before.values():
        row.pop("batch_id")
    with monkeypatch.context() as patch:
        patch.setattr(lake, "COMPACTION_FOLDER", "elsewhere")
        assert lake.compact_events(folder.spark, folder.lake) == 3
    # Its commit did not arrive: the batches are as before.
    assert len(set(r.batch_id for r in folder.events().values())) == 3
    assert lake.compact_events(folder.spark, folder.lake, max_rows=1) == 2
    assert len(set(r.batch_id for r in folder.events().values())) == 2
    assert lake.compact_events(folder.spark, folder.lake) == 2
    after = {r.event_id: r.asDict() for r in folder.events().values()}
    assert len({row.pop("batch_id") for row in after.values()}) == 1
    assert after == before
    assert lake.compact_events(folder.spark, folder.lake) == 0
    assert lake.remove_replaced(folder.spark, folder.lake, "2020-01-01") == 0
    assert lake.remove_replaced(folder.spark, folder.lake, "2100-01-01") == 4
    assert set(folder.events()) == set(before)
    folder.write("new.jsonl", line(id="same"), line(id="e9"))
    assert folder.load() == (4, 1, 3, 1)


def test_large_loads_use_and_extend_the_index(folder, monkeypatch):
    monkeypatch.setattr(loader, "MAX_BROADCAST_ROWS", 2)
    monkeypatch.setattr(id_index, "BUCKETS", 3)
    load_many(folder, 2)  # small: two lines each
    assert id_index._newest(folder.spark, folder.lake) is None
    folder.write("large.jsonl", *(line(id=i) for i in ("e0", "same", "a", "b", "b")))
    assert folder.load()[3] == 2
    index = id_index._newest(folder.spark, folder.lake)
    assert index.buckets == 3
    assert id_index._covered(folder.spark, folder.lake, index.generation).count() == 3
    folder.write("later.jsonl", line(id="c"))
    folder.load()
    folder.write("z.jsonl", *(line(id=i) for i in ("a", "c", "e1", "d", "same")))
    assert folder.load()[3] == 1
    lake.compact_events(folder.spark, folder.lake)
    id_index.rebuild(folder.spark, folder.lake, datetime(2100, 1, 1), buckets=5)
    assert id_index._newest(folder.spark, folder.lake).buckets == 5
    folder.write("zz.jsonl", *(line(id=i) for i in ("a", "d", "e1", "f", "same")))
    assert folder.load()[3] == 1
    assert stored_ids(folder) == sorted(["a", "b", "c", "d", "e0", "e1", "f", "same"])


def test_ids_of_a_load_that_broke_do_not_count(folder, monkeypatch):
    monkeypatch.setattr(loader, "MAX_BROADCAST_ROWS", 1)
    folder.write("a.jsonl", *(line(id=str(i)) for i in range(5)))

    def crash(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(loader, "commit_files", crash)
        with pytest.raises(RuntimeError):
            folder.load()
    assert folder.load() == (1, 1, 0, 5)
    folder.write("b.jsonl", *(line(id=str(i)) for i in range(6)))
    assert folder.load() == (2, 1, 1, 1)


def test_the_index_is_not_shuffled(folder, monkeypatch):
    monkeypatch.setattr(loader, "MAX_BROADCAST_ROWS", 1)
    folder.write("a.jsonl", *(line(id=str(i)) for i in range(5)))
    folder.load()
    spark = folder.spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        new = spark.range(10).selectExpr("CAST(id AS STRING) AS event_id")
        left = id_index.drop_indexed(spark, folder.lake, new)
        text = left._jdf.queryExecution().executedPlan().toString()
        assert sorted(r.event_id for r in left.collect()) == ["5", "6", "7", "8", "9"]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    scan = next(t for t in text.splitlines() if "logweir_ids_" in t)
    depth = scan.index("FileScan")
    assert "Bucketed: true" in scan
    # From the scan up to its join, nothing is exchanged.
    above = text.splitlines()[: text.splitlines().index(scan)]
    for row in reversed(above):
        at = len(row) - len(row.lstrip(" :+-"))
        if at < depth:
            depth = at
            assert "Exchange" not in row
            if "LeftAnti" in row:
                break


def test_stored_files_have_bloom_filters(folder):
    folder.write("a.jsonl", *(line(id=str(i), repo={"id": 1, "name": f"r{i}"}) for i in range(50)))
    folder.load()
    spark = folder.spark
    (path,) = (p for p in read_events(spark, folder.lake).inputFiles() if "/events/" in p)
    jvm = spark._jvm
    reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(
        jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(
            jvm.org.apache.hadoop.fs.Path(path), spark._jsc.hadoopConfiguration()
        )
    )
    try:
        columns = reader.getFooter().getBlocks().get(0).getColumns()
        filtered = {c.getPath().toDotString() for c in columns if c.getBloomFilterOffset() > 0}
    finally:
        reader.close()
    assert filtered == {"event_id", "repo_name"}


# --- landing -------------------------------------------------------------------


def texts_of(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_landed_files_are_small_and_loadable(folder):
    spark = folder.spark
    source = texts_of(
        spark, *(json.dumps({"id": str(i), "type": "é", "created_at": T, "deep": {"x": i}})
                 for i in range(400))
    ).coalesce(1)
    where = land_events(source, str(folder.raw), ingest_ts="2026-02-03T10:35:16.421955")
    assert "/landed_20260203_103516_" in where
    counts = sorted(
        len(open(os.path.join(where, name), encoding="utf-8").readlines())
        for name in os.listdir(where)
        if name.startswith("part-")
    )
    assert counts == [100, 150, 150]
    assert folder.load() == (3, 3, 0, 400)
    row = folder.events()["7"]
    assert row.ingested_at == datetime(2026, 2, 3, 10, 35, 16, 421955)
    assert json.loads(row.raw)["deep"] == {"x": 7} and row.event_type == "é"
    land_events(source, str(folder.raw))
    assert folder.load() == (6, 3, 3, 0)


@pytest.mark.parametrize("text", ["{}", " { } ", '{"id": 1}', '{"a": {"b": "}"}} '])
def test_stamp_is_added(folder, text):
    where = land_events(texts_of(folder.spark, text), str(folder.raw), ingest_ts="2026-01-01")
    (landed,) = folder.spark.read.text(where).collect()
    expected = {**json.loads(text), "_ingested_at": "2026-01-01T00:00:00Z"}
    assert json.loads(landed.value) == expected


def test_stamp_overrules(folder):
    source = texts_of(folder.spark, line(_ingested_at="2020-01-01T00:00:00Z"))
    land_events(source, str(folder.raw), ingest_ts="2026-01-01")
    folder.load()
    assert folder.events()["1"].ingested_at == datetime(2026, 1, 1)


def test_response_pages_are_split(folder):
    pages = texts_of(folder.spark, f"[{line(id='a')}, {line(id='b')}]", "[]", f"[{line(id='c')}]")
    land_events(split_response(pages), str(folder.raw))
    assert folder.load()[3] == 3


def test_invalid_record_limit(folder):
    with pytest.raises(ValueError):
        land_events(texts_of(folder.spark, line()), str(folder.raw), max_records=0)


def test_the_index_lies_in_lakes_of_any_name(folder, tmp_path, monkeypatch):
    monkeypatch.setattr(loader, "MAX_BROADCAST_ROWS", 1)
    folder.lake = str(tmp_path / "lake[1]* {a,b}")
    folder.write("a.jsonl", *(line(id=str(i)) for i in range(5)))
    assert folder.load() == (1, 1, 0, 5)
    folder.write("b.jsonl", *(line(id=str(i)) for i in range(3, 8)))
    assert folder.load() == (2, 1, 1, 3)
    assert id_index._newest(folder.spark, folder.lake) is not None
    assert stored_ids(folder) == [str(i) for i in range(8)]
