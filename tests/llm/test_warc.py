import gzip
import hashlib

import oracle
import pytest

from logweir.llm import warc
from logweir.llm.warc import OP7_SQL, op7_warc_round_trip, page_records, register

SF = "/root/testdata/sf0.001"


@pytest.fixture
def archive(spark, tmp_path):
    register(spark)
    folder = str(tmp_path / "a")

    def load(pages, **options):
        page_records(pages).write.format("warc").mode("append").save(folder)
        return spark.read.format("warc").options(**options).load(folder)

    load.folder = folder
    return load


def pages(spark, rows):
    return spark.createDataFrame(
        [(i, u, h, b"x") for i, u, h in rows],
        "page_id long, url string, html string, payload binary",
    )


def test_query_against_sql(spark):
    got = oracle.spark_rows(op7_warc_round_trip(spark, SF))
    assert got == oracle.duckdb_rows(oracle.connect(SF), OP7_SQL)


def test_round_trip_of_hard_rows(spark, archive):
    big, long = "é\r\n\r\nWARC/1.1\r\n" * 100, "x\n" * 2_000_000
    rows = [
        (1, "http://a/", big), (2, "http://b/\r\nX: y", big), (3, None, big), (None, "http://n/", big),
        (4, "u", ""), (5, "u", None), (6, "u", "short"), (7, "u", "short"), (8, "", long), (3, "again", big),
    ]
    got = archive(pages(spark, rows)).collect()
    kinds = sorted((r.record_id, r.record_type, r.refers_to) for r in got)
    first = "<urn:page:3>"
    revisits = {r.record_id for r in got if r.record_type == "revisit"}
    assert revisits == {"<urn:page:1>", "<urn:page:2>", "<urn:page>"} and len(kinds) == len(rows)
    assert {r.refers_to for r in got if r.record_type == "revisit"} == {first}
    for i, url, html in rows:
        name = "<urn:page>" if i is None else f"<urn:page:{i}>"
        data = (html or "").encode()
        for r in (r for r in got if r.record_id == name):
            assert (r.payload_bytes, r.payload_digest) == (len(data), hashlib.sha1(data).hexdigest())
            assert (r.payload is None) == (r.record_type == "revisit")
            assert r.payload in (None, data)


def test_pushed_filters_skip_payloads(spark, archive, monkeypatch, capsys):
    got = archive(pages(spark, [(i, f"http://h{i}/", f"{i}" * 50_000) for i in range(9)]))
    some = got.filter("target_uri LIKE 'http://h3%' AND payload_bytes > 10")
    assert [r.payload for r in some.collect()] == [b"3" * 50_000]
    some.explain("formatted")  # the short form of the plan leaves pushed filters out
    plan = capsys.readouterr().out
    pushed = next(line for line in plan.splitlines() if line.startswith("PushedFilters"))
    assert "StringStartsWith(target_uri,http://h3)" in pushed
    assert "GreaterThan(payload_bytes,10)" in pushed
    assert "Filter (" not in plan  # nothing is left to Spark
    # The same reader by hand: rejected records are not decoded.
    decoded = []
    more = warc.Member.more

    def counted(self, n):
        before = len(self.out)
        result = more(self, n)
        decoded.append(len(self.out) - before)
        return result

    monkeypatch.setattr(warc.Member, "more", counted)
    fs, _ = warc.file_system(archive.folder)
    total = 0
    for name, size in warc.archive_files(archive.folder):
        with fs.open_input_file(name) as file:
            total += len(list(warc.records(warc.Pieces(file, size), lambda r: False, True)))
    assert total == 0 and sum(decoded) < 9 * 50_000


def test_other_archives(spark, tmp_path):
    register(spark)
    rows = [
        {"record_type": "response", "record_id": f"<urn:{i}>", "target_uri": "u", "refers_to": None,
         "warc_date": "d", "payload_digest": None, "payload_bytes": 3, "payload": b"abc"}
        for i in range(3)
    ]
    plain = b"".join(map(warc.encode_record, rows))
    (tmp_path / "a.warc").write_bytes(plain)
    (tmp_path / "b.warc.gz").write_bytes(b"".join(gzip.compress(warc.encode_record(r)) for r in rows))
    (tmp_path / "c.txt").write_text("no archive")
    got = spark.read.format("warc").load(str(tmp_path)).collect()
    assert [r.payload for r in got] == [b"abc"] * 6
    assert spark.read.format("warc").load(str(tmp_path / "nothing")).count() == 0


def test_uncommitted_files_are_not_read(spark, archive, tmp_path):
    got = archive(pages(spark, [(1, "u", "x")]))
    (tmp_path / "a" / "part-lost.warc.gz").write_bytes(b"torn")
    assert got.count() == 1
    assert archive(pages(spark, [])).count() == 1


def test_ids_of_any_type_come_back(spark):
    names = ["a b", "é>\r\nx: y", "", None, "7", "%20"]
    text = "same " * 400
    rows = [(n, "u", text if n in ("a b", "7") else "short") for n in names]
    given = spark.createDataFrame(rows, "page_id string, url string, html string")
    got = {r.page_id: r for r in warc.round_trip(given).collect()}
    assert got.keys() == set(names)
    assert got["7"].record_type == "revisit" and got["7"].refers_to == "a b"
