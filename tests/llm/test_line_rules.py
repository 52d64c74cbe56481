import oracle
from helpers import documents, hard_documents, no_documents

from logweir.llm.line_rules import OP2_SQL, judge_lines, op2_line_frequency, repeated_words

SF = "/root/testdata/sf0.001"


def test_query_against_sql(spark):
    got = oracle.spark_rows(op2_line_frequency(spark, SF))
    assert got == oracle.duckdb_rows(oracle.connect(SF), OP2_SQL)


def test_repeated_words():
    assert repeated_words(b"a b c x a b c".split()) == 6
    assert repeated_words(b"a a a a".split()) == 4
    assert repeated_words(b"a b c d".split()) == 0
    assert repeated_words([]) == 0


def test_boilerplate_is_counted_by_host_and_distinct_text(spark):
    footer = "All rights reserved by the owners of page number {} " * 4
    own = " ".join(f"word{i}" for i in range(60))
    rows = []
    for i in range(12):  # the footer, with other digits, is most of these texts
        body = " ".join(f"n{i}x{k}" for k in range(20))
        rows.append((i, body + "\n" + footer.format(*[i % 10] * 4), "h"))
    rows += [(100 + i, footer.format(1, 1, 1, 1) + "\n" + own[:80], "other") for i in range(3)]
    rows += [(200 + i, own + "\nthe same copy", "copies") for i in range(30)]
    got = {r.doc_id: r for r in judge_lines(documents(spark, rows), min_docs=5).collect()}
    assert all(got[i].n_removed_words > 0 and not got[i].kept for i in range(12))
    assert all(got[100 + i].n_removed_words == 0 for i in range(3))
    assert all(got[200 + i].kept for i in range(30))


def test_hard_rows(spark):
    docs = hard_documents(spark)
    got = judge_lines(docs)
    rows = got.collect()
    assert len(rows) == docs.count() and "text" not in got.columns
    assert all(r.base_failed and not r.kept for r in rows if r.n_words == 0)
    assert {r.n_words for r in rows if r.doc_id == 5} == {30_000}
    assert judge_lines(no_documents(spark)).count() == 0
