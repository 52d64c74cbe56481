import random
import re

import oracle
import pyarrow as pa
import pytest
from helpers import hard_documents, no_documents

from logweir.llm import periodic
from logweir.llm.bytewords import SPACES, split_words

SF = "/root/testdata/sf0.001"


def brute(words, least=12):
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i < len(words) - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i < len(words) - q and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            if length >= max(least, 2 * q):
                found.setdefault((start, length), q)
    return sorted((s, n, q) for (s, n), q in found.items())


def texts(seed, n):
    draw = random.Random(seed)
    out = [None, "", " \n", "one", " ".join(["same"] * 400), " ".join(["a", "b"] * 99)]
    for _ in range(n):
        size, kinds = draw.choice([0, 11, 12, 13, 40, 150, 300]), draw.choice([1, 2, 3, 5, 50])
        words = [f"w{draw.randrange(kinds)}" for _ in range(size)]
        if size > 4 and draw.random() < 0.5:
            a, p = draw.randrange(size), draw.randrange(1, size // 3 + 1)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        out.append("  ".join(words))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_runs_equal_brute_force(seed):
    given = texts(seed, 250)
    words = split_words(pa.array(given), SPACES)
    text, start, length, period = periodic.runs_of(words)
    for d, own in enumerate(given):
        mine = text == d
        got = zip(start[mine] - words.bounds[d], length[mine], period[mine], strict=True)
        expected = sorted(brute((own or "").split()), key=lambda r: (r[0], r[2]))
        assert [tuple(map(int, r)) for r in got] == expected


def test_candidates_in_pieces_give_the_same(monkeypatch):
    words = split_words(pa.array(texts(9, 20)), SPACES)
    whole = [a.tolist() for a in periodic.runs_of(words)]
    monkeypatch.setattr(periodic, "MAX_PAIRS", 2000)
    assert [a.tolist() for a in periodic.runs_of(words)] == whole


def test_query_against_sql(spark):
    got = oracle.spark_rows(periodic.op11_recompression_runs(spark, SF))
    assert got == oracle.duckdb_rows(oracle.connect(SF), periodic.OP11_SQL) and got[1]


def test_collapsed_text(spark):
    rows = [(1, "start " + "x y z " * 6 + "end", "a"), (2, None, "a"), (None, "q " * 30, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string")
    got = periodic.find_runs(docs).collect()
    by_id = {r.doc_id: r for r in got}
    assert by_id[1].collapsed == "start x y z end" and by_id[1].runs == [(1, 18, 3)]
    assert by_id[2].collapsed == "" and by_id[2].runs == [] and by_id[2].n_words == 0
    assert by_id[None].collapsed == "q" and by_id[None].runs == [(0, 30, 1)]


def test_hard_rows(spark):
    docs = hard_documents(spark)
    got = periodic.find_runs(docs)
    assert got.columns == [*docs.columns, "n_words", "runs", "collapsed"]
    for row in got.collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", row.text or "")
        assert row.n_words == len(words)
        if len(words) < 1000:
            assert [tuple(r) for r in row.runs] == sorted(brute(words), key=lambda r: (r[0], r[2]))
        else:
            assert [tuple(r) for r in row.runs] == [(0, 30_000, 997)]
    assert periodic.find_runs(no_documents(spark)).count() == 0
    assert periodic.planted(docs).count() == docs.count()
