import random
import re

import oracle
import pytest
from helpers import hard_documents, no_documents
from pyspark.sql import functions as F

from logweir.llm import substrings

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window):
    first = {}
    last = float("inf")
    split = [(last if i is None else i, WORD.findall(t or "")) for i, t in rows]
    for i, words in split:
        for k in range(len(words) - window + 1):
            own = tuple(words[k : k + window])
            first[own] = min(first.get(own, last), i)
    out = []
    for (name, _), (i, words) in zip(rows, split, strict=True):
        gone = set()
        for k in range(len(words) - window + 1):
            if first[tuple(words[k : k + window])] < i:
                gone.update(range(k, k + window))
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        out.append((name, len(words), len(gone), kept))
    return sorted(out, key=repr)


def check(spark, docs, **how):
    got = substrings.remove_repeats(docs, **how)
    rows = got.select("doc_id", "n_words", "n_removed", "kept_text").collect()
    given = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert sorted(map(tuple, rows), key=repr) == brute(given, how.get("window", 50))
    return got


def corpus(seed):
    """Passages in several texts, near copies, copies, periodic texts."""
    draw = random.Random(seed)

    def prose(n):
        return [f"{draw.randrange(60)}" for _ in range(n)]

    passages = [prose(n) for n in (20, 35, 60, 90)]
    rows = []
    for i in range(60):
        words = prose(draw.randrange(60))
        for _ in range(draw.randrange(3)):
            p = draw.choice(passages)
            cut = draw.randrange(len(p) // 3)
            words += p[cut:] + prose(draw.randrange(20))
        rows.append((i, " ".join(words)))
    base = prose(120)
    for i in range(60, 90):
        near = list(base)
        near[draw.randrange(120)] = "changed"
        rows.append((i, "\n".join(near) if i % 2 else " ".join(near)))
    rows += [(i, " ".join(base)) for i in range(90, 100)]
    rows += [(100, "a " * 200), (101, "b " + "a " * 70), (102, "a b " * 60), (50, " ".join(base)), (None, " ".join(base))]
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("bound", [1, 6, 4000])
def test_equals_brute_force(spark, bound):
    docs = spark.createDataFrame(corpus(bound), "doc_id long, text string").repartition(6)
    check(spark, docs, window=20, core=4, max_records=bound)


def test_full_window_and_long_prefixes(spark):
    docs = spark.createDataFrame(corpus(3), "doc_id long, text string").repartition(3)
    check(spark, docs, max_records=5)
    check(spark, docs)


def test_frequent_prefixes_are_broadcast(spark, monkeypatch):
    monkeypatch.setattr("logweir.llm.skew.MIN_HOT_ROWS", 4)
    monkeypatch.setattr("logweir.llm.skew.MAX_HOT_KEYS", 1000)
    docs = spark.createDataFrame(corpus(4), "doc_id long, text string").repartition(6)
    check(spark, docs, window=20, core=4, max_records=8)


def test_query_against_sql(spark):
    got = oracle.spark_rows(substrings.op13_suffix_subtrees(spark, SF))
    assert got == oracle.duckdb_rows(oracle.connect(SF), substrings.OP13_SQL) and got[1]


def test_hard_rows(spark):
    docs = hard_documents(spark)
    got = check(spark, docs)
    assert got.columns == [*docs.columns, "n_words", "n_removed", "kept_text"]
    older = docs.withColumn("n_removed", F.lit("old")).withColumn("spans", F.lit("mine"))
    assert {r.spans for r in substrings.remove_repeats(older).collect()} == {"mine"}
    assert substrings.remove_repeats(no_documents(spark)).count() == 0
    # Repeats inside one id stay, those of a smaller id go.
    text = " ".join(map(str, range(80)))
    twice = spark.createDataFrame([(1, f"{text} {text}"), (1, text)], "doc_id long, text string")
    assert {r.n_removed for r in substrings.remove_repeats(twice).collect()} == {0}
