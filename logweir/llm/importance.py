"""Importance resampling towards a target text, by hashed n-gram features.

Words and their n-grams are hashed by CRC-32 into buckets, counted over the whole
corpus and over the target. A document's weight is the mean of its features' log
ratios; adding Gumbel noise that its id decides and taking the highest scores draws
documents without replacement, with odds that grow with their weight.

CRCs are taken of many features at once: the distinct ones of equal length form a
matrix of bytes, all its CRCs advance by one column at a time, and the results go
back to the places the features came from.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logweir.llm.bytewords import NOT_ALPHANUMERIC, Words, split_words, steps
from logweir.llm.common import stored, table, with_fields

BUCKETS = 10_000
# Longer features are so few per byte of text that a matrix of them would be all columns.
MAX_COLUMNS = 256


def _crc_table() -> np.ndarray:
    """Of the reflected polynomial 0xEDB88320, as in zlib."""
    entry = np.arange(256, dtype="uint32")
    for _ in range(8):
        entry = np.where(entry & 1, (entry >> 1) ^ np.uint32(0xEDB88320), entry >> 1)
    return entry


_TABLE = _crc_table()


def crc_columns(matrix: np.ndarray) -> np.ndarray:
    """CRC-32 of each row of a uint8 matrix, all rows by one column at a time."""
    crc = np.full(len(matrix), 0xFFFFFFFF, "uint32")
    for column in matrix.T:
        crc = _TABLE[(crc ^ column) & 0xFF] ^ (crc >> 8)
    return ~crc


def crc_of_features(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32 of ``data[s : s + n]`` for all pairs of ``starts`` and ``lengths``."""
    out = np.zeros(len(starts), "uint32")
    if not len(starts):
        return out
    order = np.argsort(lengths, kind="stable")
    sizes, first = np.unique(lengths[order], return_index=True)
    for size, group in zip(sizes, np.split(order, first[1:]), strict=True):
        if size == 0 or size > MAX_COLUMNS:
            out[group] = [zlib.crc32(data[s : s + size]) for s in starts[group]]
            continue
        matrix = data[starts[group][:, None] + np.arange(size)]
        fixed = pa.Array.from_buffers(
            pa.binary(int(size)), len(group), [None, pa.py_buffer(matrix)]
        ).dictionary_encode()
        distinct = np.frombuffer(fixed.dictionary.buffers()[1], "uint8")
        distinct = distinct[: len(fixed.dictionary) * size].reshape(-1, size)
        out[group] = crc_columns(distinct)[fixed.indices.to_numpy()]
    return out


def feature_buckets(words: Words, ngrams: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all features, and the number of the text each belongs to."""
    text_of, ends = words.text_of, words.starts + words.lengths
    starts, lengths, owners = [], [], []
    for n in range(1, ngrams + 1):
        here = np.arange(max(len(words) - n + 1, 0))
        here = here[text_of[here] == text_of[here + n - 1]]
        starts.append(words.starts[here])
        lengths.append(ends[here + n - 1] - words.starts[here])
        owners.append(text_of[here])
    crc = crc_of_features(words.data, np.concatenate(starts), np.concatenate(lengths))
    return crc.astype("int64") % buckets, np.concatenate(owners)


def bucket_counts(docs: DataFrame, text_col: str, ngrams: int, buckets: int) -> np.ndarray:
    """Features of all texts by bucket, added up in tasks before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, "int64")
        for batch in batches:
            for part in steps(batch, text_col):
                words = split_words(part.column(text_col), NOT_ALPHANUMERIC, lower=True)
                found, _ = feature_buckets(words, ngrams, buckets)
                total += np.bincount(found, minlength=buckets)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["bucket", "n"])

    counted = docs.select(text_col).mapInArrow(run, "bucket long, n long")
    counts = np.zeros(buckets, "int64")
    # As many rows as there are buckets, a parameter.
    for row in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        counts[row.bucket] = row.n
    return counts


def fit_gains(
    docs: DataFrame,
    target: DataFrame,
    ngrams: int = 1,
    buckets: int = BUCKETS,
    text_col: str = "text",
) -> np.ndarray:
    """Each bucket's smoothed log ratio of target to corpus, in thousandths, floored."""
    corpus = bucket_counts(docs, text_col, ngrams, buckets)
    wanted = bucket_counts(target, text_col, ngrams, buckets)
    s_all, t_all = float(corpus.sum() + buckets), float(wanted.sum() + buckets)
    return np.array(
        [
            math.floor(1000 * math.log((t + 1) * s_all / ((s + 1) * t_all)))
            for s, t in zip(corpus.tolist(), wanted.tolist(), strict=True)
        ],
        "int64",
    )


def weigh(
    docs: DataFrame, gains: np.ndarray, ngrams: int = 1, text_col: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """``docs`` (or its columns ``keep``) with ``n_words``, ``n_features``, ``weight``.

    The weight is the floored mean of the gains of a text's features, repeats counted,
    and 0 without features: null and empty texts. Older columns of these names are
    replaced.
    """
    made = ["n_words", "n_features", "weight"]
    keep = [name for name in (docs.columns if keep is None else keep) if name not in made]
    names = [*keep, *made]
    shipped = docs.sparkSession.sparkContext.broadcast(gains)  # one long per bucket

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shipped.value
        for batch in batches:
            for part in steps(batch, text_col):
                words = split_words(part.column(text_col), NOT_ALPHANUMERIC, lower=True)
                found, owner = feature_buckets(words, ngrams, len(own))
                n = np.bincount(owner, minlength=part.num_rows)
                total = np.zeros(part.num_rows, "int64")
                np.add.at(total, owner, own[found])
                made = [words.counts, n, total // np.maximum(n, 1)]
                columns = [part.column(name) for name in keep]
                yield pa.RecordBatch.from_arrays([*columns, *map(pa.array, made)], names)

    inputs = docs.select(*dict.fromkeys([*keep, text_col]))
    schema = with_fields(docs.select(*keep), n_words="long", n_features="long", weight="long")
    return inputs.mapInArrow(run, schema)


def gumbel_score(weight: Column, id_: Column, seed: int) -> Column:
    """``weight`` plus Gumbel noise in thousandths; a null id is hashed as no text."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))
    return weight + noise.cast("long")


def draw(
    weighed: DataFrame, percent: int = 10, min_words: int = 20, seed: int = 2024, id_col: str = "doc_id"
) -> DataFrame:
    """``weighed`` with ``score`` and ``rank``: 1, 2, ... for the documents drawn.

    Of the N documents with at least ``min_words`` words, floor(percent * N / 100) with
    the highest scores are drawn; ties go to smaller ids, a null id last, then to the
    shorter text; rows equal in all this are interchangeable and still get ranks of
    their own. An empty table stays empty.

    A histogram of the scores gives the lowest score that is drawn. Only documents
    from there on are sorted, by range over all tasks; ranges are written down, so
    that ranks hold when an executor is lost.
    """
    score = gumbel_score(F.col("weight"), F.col(id_col), seed)
    kept = stored(weighed.drop("score", "rank").withColumn("score", score).withColumn("tie_", F.rand(seed)))
    fit = F.col("n_words") >= min_words
    wanted = kept.filter(fit).count() * percent // 100
    no_rank = F.lit(None).cast("long").alias("rank")
    # Scores are whole thousandths of logarithms of 64-bit numbers: at most some
    # 100 000 values, however many documents there are.
    down = Window.orderBy(F.desc("score"))
    last = (
        kept.filter(fit)
        .groupBy("score")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("so_far", F.sum("n").over(down))
        .filter(F.col("so_far") >= wanted)
        .agg(F.max("score").alias("lowest"))
        .first()
    )
    plain = [c for c in kept.columns if c != "tie_"]
    if not wanted or last.lowest is None:
        return kept.select(*plain, no_rank)
    high = fit & (F.col("score") >= last.lowest)
    order = [F.desc("score"), F.asc_nulls_last(id_col), "n_words", "n_features", "tie_"]
    ranges = stored(
        kept.filter(high).repartitionByRange(*order).withColumn("range_", F.spark_partition_id())
    )
    before = Window.orderBy("range_").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each shuffle partition.
    offsets = ranges.groupBy("range_").agg(F.count(F.lit(1)).alias("n_")).select(
        "range_", F.coalesce(F.sum("n_").over(before), F.lit(0)).alias("before_")
    )
    inside = F.row_number().over(Window.partitionBy("range_").orderBy(*order))
    place = F.col("before_") + F.col("inside_")
    ranked = (
        ranges.withColumn("inside_", inside)
        .join(F.broadcast(offsets), "range_")
        .select(*plain, F.when(place <= wanted, place).alias("rank"))
    )
    return ranked.union(kept.filter(~F.coalesce(high, F.lit(False))).select(*plain, no_rank))


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 10,
    min_words: int = 20,
    ngrams: int = 1,
    buckets: int = BUCKETS,
    seed: int = 2024,
) -> DataFrame:
    """The drawn documents, whole rows with ``score`` and ``rank``.

    Null and empty texts and texts under ``min_words`` words are never drawn. An empty
    target gives every feature the same low gain, so that noise alone decides.
    """
    gains = fit_gains(docs, target, ngrams, buckets)
    return draw(weigh(docs, gains, ngrams), percent, min_words, seed).filter("rank IS NOT NULL")


def op12_crc_importance(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    gains = fit_gains(docs, table(spark, sf_dir, "benchmark").select("text"))
    drawn = draw(weigh(docs, gains, keep=["doc_id"]))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


# DuckDB has no CRC-32; distinct words are few, and their CRCs are folded byte by byte.
OP12_SQL = r"""
WITH codes AS (
    SELECT list(list_reduce([i::UBIGINT] || [x::UBIGINT FOR x IN range(8)],
        lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END)
        ORDER BY i) AS t
    FROM range(256) r(i)
),
d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
),
b AS (
    SELECT unnest(regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word
    FROM benchmark
),
u AS (SELECT doc_id, unnest(w) AS word FROM d),
known AS (SELECT word FROM u UNION SELECT word FROM b),
bytes AS (
    SELECT word, hex(encode(word)) AS x FROM known
),
crcs AS (
    SELECT word, xor(list_reduce([4294967295::UBIGINT] ||
        [('0x' || substr(x, 2 * i + 1, 2))::UBIGINT FOR i IN range(length(x) // 2)],
        lambda c, y: xor(t[(xor(c, y) & 255)::BIGINT + 1], c >> 8)), 4294967295::UBIGINT) % 10000 AS bucket
    FROM bytes, codes
),
s AS (SELECT bucket, count(*) AS n FROM u JOIN crcs USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM b JOIN crcs USING (word) GROUP BY bucket),
totals AS (SELECT (SELECT count(*) FROM u) AS s_all, (SELECT count(*) FROM b) AS t_all),
gains AS (
    SELECT bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * (s_all + 10000)
        / ((s.n + 1)::DOUBLE * (t_all + 10000))))::BIGINT AS gain
    FROM s LEFT JOIN t USING (bucket), totals
),
weights AS (
    SELECT doc_id, count(*) AS n, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
    FROM u JOIN crcs USING (word) JOIN gains USING (bucket) GROUP BY doc_id
),
scored AS (
    SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
        coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT
            + 0.5) / 4294967296)))::BIGINT AS score
    FROM d LEFT JOIN weights USING (doc_id)
),
ranked AS (
    SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place,
        count(*) OVER () * 10 // 100 AS wanted
    FROM scored WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= wanted THEN place END AS rank
FROM scored LEFT JOIN ranked USING (doc_id)
"""
