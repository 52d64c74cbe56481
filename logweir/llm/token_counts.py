"""Token counts by a map-side, two-tier lookup of pre-token lengths.

A piece of the sentencepiece model never goes on past a space, so a text's token
count is the sum over its pre-tokens: a run of spaces with the non-spaces behind
it. The length of a pre-token comes from

1. a compact hash table of frequent ones, broadcast to all tasks and bounded by
   ``table_size`` entries of at most ``LONGEST`` characters;
2. for the others, a cache in each Python worker, filled by encoding.

No pre-token is shuffled by the counting. The table is drawn from a random sample
of the documents. It decides about speed only: a length is the library's own
whichever tier gives it.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweir.llm.common import table, with_fields

MODEL = "piece_bpe_32k.model"
# Documents, about, that the table of frequent pre-tokens is drawn from.
SAMPLE_DOCS = 2_000
TABLE_SIZE = 32_768
# Longer pre-tokens are encoded each time they occur.
LONGEST = 64
# Entries of a worker's cache; it starts anew when full.
CACHE_SIZE = 500_000

_PRE_TOKEN = re.compile(" +[^ ]+| +$")
_TOKENIZERS: dict[str, object] = {}


def model_path(name: str = MODEL) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pre_tokens(text: str) -> list[str]:
    """The parts of a text that the model encodes independently.

    The model puts a space before the text, and U+2581 is its own sign for one.
    """
    return _PRE_TOKEN.findall(" " + text.replace("▁", " ")) if text else []


def _tokenizer(model: str):
    if model not in _TOKENIZERS:
        import sentencepiece

        _TOKENIZERS[model] = sentencepiece.SentencePieceProcessor(model_file=model)
    return _TOKENIZERS[model]


def length(tokenizer, pre_token: str) -> int:
    """Tokens of one pre-token; the library adds the first space itself."""
    return len(tokenizer.encode(pre_token[1:])) if pre_token != " " else 1


class Lengths(dict):
    """The broadcast table, with the worker's cache behind it."""

    def __init__(self, frequent: dict[str, int], tokenizer, cache_size: int):
        super().__init__(frequent)
        self.cache: dict[str, int] = {}
        self.tokenizer, self.cache_size = tokenizer, cache_size
        self.encoded = 0

    def __missing__(self, pre_token: str) -> int:
        known = self.cache.get(pre_token)
        if known is None:
            known = length(self.tokenizer, pre_token)
            self.encoded += 1
            if len(pre_token) <= LONGEST:
                if len(self.cache) >= self.cache_size:
                    self.cache.clear()
                self.cache[pre_token] = known
        return known

    def count(self, text: str | None) -> int:
        return sum(map(self.__getitem__, pre_tokens(text))) if text else 0


def frequent_lengths(
    texts: DataFrame, model: str, sample_docs: int, table_size: int
) -> dict[str, int]:
    """Lengths of the most frequent pre-tokens in a random sample of ``texts``."""
    rows = texts.count()
    if not rows or not sample_docs or not table_size:
        return {}
    sample = texts.sample(min(1.0, sample_docs / rows), seed=1)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for text in batch.column(0):
                seen.update(pre_tokens(text.as_py() or ""))
        top = [x for x in seen.most_common(table_size) if len(x[0]) <= LONGEST]
        words, counts = [w for w, _ in top], [n for _, n in top]
        yield pa.RecordBatch.from_arrays(
            [pa.array(words, pa.string()), pa.array(counts, pa.int64())], ["word", "n"]
        )

    top = (
        sample.mapInArrow(summed, "word string, n long")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "word")
        .limit(table_size)
    )
    tokenizer = _tokenizer(model)
    return {row.word: length(tokenizer, row.word) for row in top.collect()}


def count_tokens(
    docs: DataFrame,
    model: str | None = None,
    text_col: str = "text",
    sample_docs: int = SAMPLE_DOCS,
    table_size: int = TABLE_SIZE,
    cache_size: int = CACHE_SIZE,
) -> DataFrame:
    """``docs`` with ``n_tokens`` (long) in place of the text.

    A null or empty text has 0 tokens. All other columns are kept as they are; an
    older ``n_tokens`` column is replaced. ``model`` is the path of a sentencepiece
    BPE model whose pieces keep spaces at their start, the same on all nodes.
    """
    model = model or model_path()
    docs = docs.drop("n_tokens")
    frequent = docs.sparkSession.sparkContext.broadcast(
        frequent_lengths(docs.select(text_col), model, sample_docs, table_size)
    )
    rest = docs.drop(text_col)
    names = [*rest.columns, "n_tokens"]
    at = docs.columns.index(text_col)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = Lengths(frequent.value, _tokenizer(model), cache_size)
        for batch in batches:
            counts = [lengths.count(text.as_py()) for text in batch.column(at)]
            columns = [c for i, c in enumerate(batch.columns) if i != at]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(counts, pa.int64())], names
            )

    return docs.mapInArrow(count, with_fields(rest, n_tokens="long"))


def op3_two_tier_counts(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        "text",
    )
    return count_tokens(docs).withColumn("over_limit", F.col("n_tokens") > 4096)
