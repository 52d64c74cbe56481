import random

import sentencepiece
from helpers import hard_documents, no_documents

from logweir.llm import token_counts
from logweir.llm.token_counts import count_tokens, model_path, op3_two_tier_counts

SF = "/root/testdata/sf0.001"


def library():
    return sentencepiece.SentencePieceProcessor(model_file=model_path())


def test_query_against_the_library(spark):
    tokenizer = library()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = op3_two_tier_counts(spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        text = texts[r.doc_id] or ""
        n = len(tokenizer.encode(text))
        assert (r.n_tokens, r.n_bytes, r.over_limit) == (n, len(text.encode()), n > 4096)


def test_odd_texts_and_tiers():
    tokenizer = library()
    random.seed(5)
    signs = [" ", "  ", "▁", "a", "the", "<s>", "</s>", "\n", "\t", "é", "😀", "\x00", "12", "ﬁ"]
    texts = ["".join(random.choices(signs, k=random.randrange(12))) for _ in range(2000)]
    texts += ["<0x0A>", " ", "▁", "x" * 300, " " * 70 + "y"]
    small = token_counts.Lengths({" the": 1}, tokenizer, cache_size=10)
    assert [small.count(t) for t in texts] == [len(tokenizer.encode(t)) for t in texts]
    before = small.encoded
    small.count("the the")
    assert small.encoded == before


def test_hard_rows(spark):
    docs = hard_documents(spark)
    tokenizer = library()
    for options in ({}, {"sample_docs": 0}, {"table_size": 3, "cache_size": 2}):
        got = count_tokens(docs, **options).collect()
        expected = [len(tokenizer.encode(r.text or "")) for r in docs.collect()]
        assert sorted(r.n_tokens for r in got) == sorted(expected)
    assert count_tokens(no_documents(spark)).count() == 0
