import sys
from pathlib import Path

from helpers import hard_documents, no_documents
from pyspark.sql import functions as F
from test_jaccard_join import brute_force
from test_sharding import check_shards

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from corpus_pipeline import STAGES, run  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_stages_on_the_documents(spark):
    """Each stage against what it has to do with the rows before it."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    tables = [docs]
    for _, stage in STAGES:
        tables.append(stage(spark, tables[-1], SF).cache())
    ids = [sorted(r.doc_id for r in t.select("doc_id").collect()) for t in tables]
    assert all(t.columns == docs.columns for t in tables[:-1])
    assert tables[-1].columns == [*docs.columns, "shard", "slot"]
    assert set(ids[1]) < set(ids[0]) and len(ids[1]) > 0.8 * len(ids[0])
    rows = [(r.doc_id, r.text, None) for r in tables[1].collect()]
    assert ids[2] == sorted({c for _, c in brute_force(rows, 90).values()})
    assert set(ids[3]) <= set(ids[2])
    assert all(ids[4].count(i) <= 2 for i in ids[4]) and set(ids[4]) <= set(ids[3])
    assert ids[5] == ids[4]
    check_shards([(r.shard, r.slot) for r in tables[-1].collect()], 24)


def test_run_writes_and_rereads(spark, monkeypatch):
    monkeypatch.setattr(corpus_pipeline, "STAGES", STAGES[-1:])
    assert run(spark, SF).count() == 200


def test_stages_bear_hard_rows(spark):
    """Columns that an operator uses for its results come through with their values."""
    given = hard_documents(spark).select("doc_id", "text", "lang", "source", "n_chars", "pos")
    given = given.withColumn("score", F.lit(0.25)).withColumn("predicted", F.lit("mine"))
    given = given.withColumn("n_shingles", F.lit(7))
    before = {(r.doc_id, r.text) for r in given.collect()}
    docs = given
    for name, stage in STAGES:
        found = stage(spark, docs, SF).cache()
        rows = found.collect()
        assert {(r.doc_id, r.text) for r in rows} <= before
        assert {(r.score, r.predicted, r.n_shingles) for r in rows} <= {(0.25, "mine", 7)}
        if name == "near_duplicates":
            assert sum(r.doc_id in (1, 2) for r in rows) <= 1
        if name != "sharding":
            assert found.columns == given.columns
        docs = found
    check_shards([(r.shard, r.slot) for r in docs.collect()], 24)
    for _, stage in STAGES:
        assert stage(spark, no_documents(spark), SF).count() == 0
