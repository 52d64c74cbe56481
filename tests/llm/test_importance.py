import hashlib
import math
import re
import zlib

import numpy as np
import oracle
from helpers import hard_documents, no_documents
from pyspark.sql import functions as F

from logweir.llm import importance

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text, ngrams):
    words = WORD.findall((text or "").translate(LOWER))
    runs = [words[i : i + n] for n in range(1, ngrams + 1) for i in range(len(words) - n + 1)]
    return words, [zlib.crc32(" ".join(run).encode()) for run in runs]


def test_crcs_by_columns_equal_zlib():
    pieces = [b"x" * n + bytes([n % 256]) * 3 for n in range(1, 300)] * 2 + [b"", b"\xff\x00"]
    data = np.frombuffer(b"".join(pieces), "uint8")
    lengths = np.array([len(p) for p in pieces])
    starts = np.cumsum(lengths) - lengths
    got = importance.crc_of_features(data, starts, lengths)
    assert got.tolist() == [zlib.crc32(p) for p in pieces]


def brute(docs, target, ngrams, buckets, percent, least, seed=2024):
    s, t = np.zeros(buckets, int), np.zeros(buckets, int)
    for own, counts in ((docs, s), (target, t)):
        for row in own:
            for crc in features(row.text, ngrams)[1]:
                counts[crc % buckets] += 1
    high, low = int(s.sum()) + buckets, int(t.sum()) + buckets
    gain = [math.floor(1000 * math.log((b + 1) * high / ((a + 1) * low))) for a, b in zip(s.tolist(), t.tolist())]
    rows = []
    for row in docs:
        words, crcs = features(row.text, ngrams)
        weight = sum(gain[c % buckets] for c in crcs) // max(len(crcs), 1)
        name = "" if row.doc_id is None else str(row.doc_id)
        h = int(hashlib.sha256(f"{seed}:{name}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((row.doc_id, len(words), len(crcs), weight, score))
    fit = [r for r in rows if r[1] >= least]
    fit.sort(key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[1], r[2]))
    drawn = fit[: percent * len(fit) // 100]
    ranked = [(*r, place) for place, r in enumerate(drawn, 1)]
    for r in drawn:
        rows.remove(r)
    return sorted(ranked + [(*r, None) for r in rows], key=repr)


def check(spark, docs, target, ngrams=1, buckets=500, percent=10, least=20):
    gains = importance.fit_gains(docs, target, ngrams, buckets)
    weighed = importance.weigh(docs, gains, ngrams)
    got = importance.draw(weighed, percent, least)
    columns = ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    rows = sorted((tuple(r) for r in got.select(*columns).collect()), key=repr)
    assert rows == brute(docs.collect(), target.collect(), ngrams, buckets, percent, least)
    assert set(docs.columns) <= set(got.columns)


def test_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").repartition(5)
    target = spark.read.parquet(f"{SF}/benchmark.parquet")
    check(spark, docs, target)
    check(spark, docs, target, ngrams=3, buckets=97, percent=100, least=1)


def test_query_against_sql(spark):
    got = oracle.spark_rows(importance.op12_crc_importance(spark, SF))
    assert got == oracle.duckdb_rows(oracle.connect(SF), importance.OP12_SQL) and got[1]


def test_hard_rows(spark):
    docs = hard_documents(spark)
    target = spark.createDataFrame([("Lazy dog",), (None,), ("",)], "text string")
    check(spark, docs, target, percent=60)
    check(spark, docs, target.filter("false"), percent=100, least=0)
    empty = no_documents(spark)
    assert importance.resample(empty, target).count() == 0
    older = docs.withColumn("score", F.lit("old")).withColumn("weight", F.lit("old"))
    kept = importance.resample(older, target, percent=100)
    assert kept.count() == sum(len(features(r.text, 1)[0]) >= 20 for r in docs.collect())


def test_ranks_over_many_ranges_and_equal_scores(spark):
    rows = spark.range(3000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 7 ELSE id END AS doc_id", "20L AS n_words", "20L AS n_features", "0L AS weight"
    )
    ranks = [r.rank for r in importance.draw(rows, 50).collect() if r.rank]
    assert sorted(ranks) == list(range(1, 1501))
