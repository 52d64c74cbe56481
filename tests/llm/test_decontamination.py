import oracle
from helpers import documents, hard_documents, no_documents

from logweir.llm.decontamination import (
    OP6_SQL,
    build_index,
    contamination,
    decontaminate,
    find,
    op6_positional_index,
    term_ids,
)

SF = "/root/testdata/sf0.001"
PHRASE = "Alpha beta, gamma delta: epsilon zeta eta theta iota kappa lambda mu"


def items(spark, *rows):
    return spark.createDataFrame([(i, t, 1) for i, t in rows], "item_id long, text string, pos int")


def test_query_against_sql(spark):
    got = oracle.spark_rows(op6_positional_index(spark, SF))
    assert got == oracle.duckdb_rows(oracle.connect(SF), OP6_SQL)


def test_hits(spark):
    rows = [
        (1, "x " + PHRASE.upper() + " y", "a"),  # two windows and one between: all 12 words
        (2, " ".join(PHRASE.split()[:9]), "a"),
        (3, "one two one two", "a"),
        (4, PHRASE.replace("zeta", "other"), "a"),
        (5, "one, two; " + " ".join(PHRASE.split()[2:]), "a"),
    ]
    bench = items(spark, (10, PHRASE), (9, PHRASE), (7, "One two"), (8, None), (6, " ,;"), (None, "one two"))
    got = {r.doc_id: r for r in contamination(documents(spark, rows), bench).collect()}
    assert [got[i].n_hit for i in range(1, 6)] == [12, 0, 4, 0, 12]
    assert got[1].item_ids == ["10", "9"] and got[3].item_ids == ["7"]
    assert got[5].item_ids == ["10", "7", "9"]
    kept = decontaminate(documents(spark, rows), bench)
    assert sorted(r.doc_id for r in kept.collect()) == [2, 4]


def test_proximity(spark):
    docs = documents(spark, [(1, "a b c d", "s"), (2, "a x b c d", "s"), (3, "d c b a", "s")])
    phrases = spark.createDataFrame([(0, ["a", "b", "c", "d"]), (1, ["c"])], "phrase long, words array<string>")
    terms = term_ids(phrases.selectExpr("explode(words) AS term"))
    index = build_index(docs, terms)
    ids = {r.row_id: r.doc_id for r in index.filter("term_id = 0").collect()}

    def rows(slop):
        return {(r.phrase, ids[r.row_id]) for r in find(index, phrases, terms, slop).collect()}

    assert rows(0) == {(0, 1), (1, 1), (1, 2), (1, 3)}
    assert rows(1) == {(0, 1), (0, 2), (1, 1), (1, 2), (1, 3)}


def test_hard_rows(spark):
    docs = hard_documents(spark)
    bench = items(spark, (1, "quick brown fox jumps over the lazy dog again and again"), (1, "one"))
    got = contamination(docs, bench).collect()
    assert len(got) == docs.count()
    assert sorted(r.doc_id for r in got if r.n_hit and r.doc_id) == [1, 1, 2, 7]
    assert decontaminate(docs, bench).columns == docs.columns
    assert decontaminate(docs, bench.limit(0)).count() == docs.count()
    assert contamination(no_documents(spark), bench).count() == 0
