import zlib

import numpy as np
import pandas as pd
from helpers import hard_documents, no_documents
from pyspark.sql import functions as F

from logweir.llm import quality, severity
from logweir.llm.common import held_out, labelled_sample

SF = "/root/testdata/sf0.01"


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_quality_on_held_out_documents(spark):
    scored = quality.op10_subword_quality(spark, SF)
    known = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality")
    rows = scored.join(known, "doc_id").filter("held_out").collect()
    assert len(rows) > 80
    assert np.mean([r.predicted == r.quality for r in rows]) >= 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert all(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in rows)


def test_severity_on_held_out_documents_of_each_language(spark):
    """On the larger table, as the small one has some 20 toxic labels held out."""
    large = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{large}/documents.parquet").select("doc_id", "text", "lang")
    known = spark.read.parquet(f"{large}/labels.parquet")
    marked = docs.join(known.select("doc_id", F.col("toxic").alias("y")), "doc_id")
    model = severity.fit_severity(docs, known)
    rows = severity.score_severity(marked.filter(held_out(F.col("doc_id"))), model)
    rows = rows.select("lang", F.col("toxic").alias("flag"), "severity", "score", "y").collect()
    for lang in ("en", "de", "fr", "es"):
        own = [r for r in rows if r.lang == lang]
        assert np.mean([r.flag for r in own if r.y]) >= 0.8
        assert np.mean([r.flag for r in own if not r.y]) <= 0.02
    assert all(r.flag == (r.score >= 0.5) for r in rows)
    assert {r.severity for r in rows if r.y} == {0, 1, 2, 3}


def test_query_gives_one_row_for_each_document(spark):
    rows = severity.op4_ordinal_severity(spark, SF)
    assert rows.columns[0] == "doc_id" and "score" in rows.columns
    assert rows.count() == spark.read.parquet(f"{SF}/documents.parquet").count()


def test_ordinal_regression_recovers_the_order():
    texts = ["fine words here"] * 40 + ["bad fine"] * 20 + ["bad worse fine"] * 20
    grade = np.array([0] * 40 + [1] * 20 + [2] * 20)
    x = severity.matrix(texts, ["bad$", "worse$", "wor", "fine$"])
    weights, thresholds = severity.fit_ordinal(x, grade, np.ones(80))
    model = severity.Severity(dict(zip(x.names, weights.tolist())), thresholds)
    assert (np.diff(thresholds) > 0).all()
    signals = np.array([model.signal(t) for t in ("fine words", "bad fine", "bad worse fine")])
    assert np.allclose(signals[1:], x.signals(weights)[[40, 60]])
    expected = model.above(signals).sum(axis=1)
    assert expected[0] < 0.5 < expected[1] < 1.5 < expected[2]


def test_expected_severity_equals_the_sum_over_grades():
    """By force: each grade's probability from the cumulative link, times the grade."""
    model = severity.Severity({"bad$": 1.5, "wor": -0.3}, np.array([-0.5, 0.4, 2.0]))
    for text in ("", None, "bad", "bad bad worse " * 40, "fine " * 300 + "bad"):
        words = [w for w in (text or "").split()]
        x = {
            f: np.log1p(100 * sum(g(w) for w in words) / max(len(words), 100))
            for f, g in {"bad$": lambda w: w == "bad", "wor": lambda w: w.startswith("wor")}.items()
        }
        eta = sum(model.weights[f] * x[f] for f in x)
        below = [1 / (1 + np.exp(-(t - eta))) for t in model.thresholds]
        shares = np.diff([0, *below, 1])
        got = model.above(np.array([model.signal(text)]))[0]
        assert np.isclose(got.sum(), (shares * np.arange(4)).sum())


def test_a_stem_with_many_endings_is_one_feature():
    texts = [f"vorde{i} stemx{i} andere" for i in range(40)] + [f"ruhig{i} satz andere" for i in range(400)]
    toxic = np.array([1] * 40 + [0] * 400)
    model = severity.fit_texts(texts, toxic, np.ones(440))
    scores = model.above(np.array([model.signal("neu stemx99"), model.signal("neu satz")]))[:, 0]
    assert scores[0] > 0.5 > scores[1]


def test_subwords_of_unseen_words():
    good = [f"plain{i} words{i}" for i in range(60)]
    bad = [f"junk{i}$$$ more{i}$$$" for i in range(60)]
    frame = pd.DataFrame({"text": good + bad, "label": [1] * 60 + [0] * 60})
    scorer = quality.Scorer(quality.train(frame), cache_words=5)
    scores = scorer.score(["plain900 words901", "other77$$$ thing$$$", "", None])
    assert scores[0] > 0.5 > scores[1] and scores[2] == scores[3]
    again = quality.Scorer(quality.train(frame)).score(["plain900 words901", "other77$$$ thing$$$"])
    assert list(again) == list(scores[:2])


def test_labels_of_the_held_out_fold_are_never_drawn(spark):
    docs = spark.range(300).selectExpr("id AS doc_id", "concat('t', id) AS text")
    marks = labels(spark, [(i, i % 2, 0) for i in range(300)])
    sample, counts = labelled_sample(docs, marks, "quality", 40)
    rows = sample.collect()
    assert len(rows) == 80 and sum(counts.values()) < 300
    assert all(zlib.crc32(str(r.doc_id).encode()) % 3 != 1 for r in rows)


def test_hard_rows_and_missing_labels(spark):
    docs = hard_documents(spark)
    for marks in ([], [(1, 1, 0)], [(2, 0, 1), (None, 1, 0), (3, None, None)]):
        table = labels(spark, marks)
        model = quality.fit_quality(docs, table)
        got = quality.score_quality(docs, model)
        assert got.columns == [*docs.columns, "score", "predicted"]
        assert all(0 <= r.score <= 1 for r in got.collect()) and got.count() == docs.count()
        mild = severity.score_severity(docs, severity.fit_severity(docs, table))
        assert all(r.expected_severity >= 0 for r in mild.collect())
    both = labels(spark, [(1, 1, 0), (5, 0, 1), (6, 1, 0), (7, 0, 1), (2, 1, 1), (3, 0, 0)])
    assert quality.score_quality(docs, quality.fit_quality(docs, both)).count() == docs.count()
    assert severity.score_severity(docs, severity.fit_severity(docs, both)).count() == docs.count()
    empty = no_documents(spark)
    assert quality.score_quality(empty, quality.fit_quality(empty, both)).count() == 0
    assert severity.score_severity(empty, severity.fit_severity(empty, both)).count() == 0


def test_training_holds_features_of_a_piece_of_the_vocabulary(monkeypatch):
    words = [f"w{i}" for i in range(3 * quality.PIECE)]
    frame = pd.DataFrame({"text": [" ".join(words[i::8]) for i in range(8)], "label": [0, 1] * 4})
    sizes, whole = [], quality.word_features

    def counted(words, buckets):
        sizes.append(len(words))
        return whole(words, buckets)

    monkeypatch.setattr(quality, "word_features", counted)
    quality.train(frame, epochs=1)
    assert sum(sizes) == len(words) and max(sizes) <= quality.PIECE
    encoded = [w.encode() for w in words]
    for got, expected in zip(quality.features_in_pieces(encoded), whole(encoded), strict=True):
        assert (got == expected).all()
    assert [len(part) for part in quality.features_in_pieces([])] == [0, 0]
