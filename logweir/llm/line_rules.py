"""Quality rules, with boilerplate found by cross-document line frequency.

Lines are normalised (A-Z to a-z, digits to 0, white space to single spaces) and
hashed. For every host the distinct documents with a line are counted; a line in
more than ``max(min_docs, max_share * documents of the host)`` of them is removed.
A document that loses more than ``max_removed`` of its words is depleted and goes.
Exact copies of a text count as one document, so copying alone makes no boilerplate.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweir.llm.common import stored, table, with_fields, within_bound

WHITE = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
_NORMAL = bytes(
    ord("0") if 48 <= c <= 57 else c + 32 if 65 <= c <= 90 else c for c in range(256)
)
MEASURES = "n_words word_chars n_symbols n_dup_lines n_repeat_words".split()


def repeated_words(words: list[bytes]) -> int:
    """Words inside three-word windows that occur at least twice."""
    n = len(words)
    if n < 4:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), "int64", n)
    size = len(numbers)
    if size == n:
        return 0
    pairs = ids[:-1] * size + ids[1:]
    if size > 2_000_000:  # the product of three numbers would not fit
        size, pairs = n, np.unique(pairs, return_inverse=True)[1]
        windows = pairs[:-1] * size + ids[2:]
    else:
        windows = pairs[:-1] * size + ids[2:]
    _, place, count = np.unique(windows, return_inverse=True, return_counts=True)
    twice = count[place] > 1
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[shift : n - 2 + shift] |= twice
    return int(covered.sum())


def measure(text: str | None) -> tuple[list[int], list[tuple[int, int]]]:
    """The five measures of a text, and its distinct lines as (hash, words)."""
    if not text:
        return [0] * 5, []
    data = text.encode()
    words = data.split()
    white = len(data) - len(data.translate(None, WHITE))
    symbols = len(data) - len(data.translate(None, SYMBOLS))
    lines = [line for line in data.split(b"\n") if line.translate(None, WHITE)]
    total: dict[int, int] = {}
    for line in lines:
        parts = line.translate(_NORMAL).split()
        key = xxhash.xxh64_intdigest(b" ".join(parts)) - (1 << 63)
        total[key] = total.get(key, 0) + len(parts)
    measures = [
        len(words),
        len(text) - white,
        symbols,
        len(lines) - len(set(lines)),
        repeated_words(words),
    ]
    return measures, list(total.items())


def measured(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the five measures and ``lines_`` in place of the text."""
    rest = docs.drop(text_col, *MEASURES)
    names = [*rest.columns, *MEASURES, "lines_"]
    keep = rest.columns
    line = pa.list_(pa.struct([("hash", pa.int64()), ("words", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers, lines = [], []
            for text in batch.column(text_col):
                values, own = measure(text.as_py())
                numbers.append(values)
                lines.append([{"hash": h, "words": n} for h, n in own])
            table_ = np.array(numbers, "int64").reshape(-1, 5)
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in keep],
                    *[pa.array(table_[:, i]) for i in range(5)],
                    pa.array(lines, line),
                ],
                names,
            )

    types = {name: "long" for name in MEASURES}
    types["lines_"] = "array<struct<hash:long,words:long>>"
    return docs.mapInArrow(run, with_fields(rest, **types))


def judge_lines(
    docs: DataFrame,
    host_col: str = "source",
    text_col: str = "text",
    min_docs: int = 20,
    max_share: float = 0.1,
    max_removed: float = 0.5,
) -> DataFrame:
    """``docs`` without the text, with the measures, ``n_removed_words``,
    ``base_failed`` and ``kept``.

    Null hosts form one host; null and empty texts have no words and fail the base
    rules. Repeated rows are judged alike, each by itself. Older columns of the
    names given here are replaced, names ending in ``_`` are reserved.
    """
    made = [*MEASURES, "n_removed_words", "base_failed", "kept"]
    docs = docs.drop(*made)
    others = [c for c in docs.columns if c != text_col]
    keyed = docs.withColumns(
        {
            "row_": F.monotonically_increasing_id(),
            "text_hash_": F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))),
            "host_": F.coalesce(F.concat(F.lit("h"), F.col(host_col).cast("string")), F.lit("")),
        }
    )
    rows = stored(measured(keyed, text_col))
    lines = rows.select("row_", "host_", "text_hash_", F.explode("lines_").alias("line_")).select(
        "row_", "host_", "text_hash_", "line_.hash", "line_.words"
    )
    hosts = rows.groupBy("host_").agg(F.count_distinct("text_hash_").alias("host_docs_"))
    hosts = stored(hosts)
    most = F.greatest(F.lit(float(min_docs)), F.col("host_docs_") * F.lit(float(max_share)))
    frequent = stored(
        lines.select("host_", "hash", "text_hash_")
        .distinct()
        .groupBy("host_", "hash")
        .agg(F.count(F.lit(1)).alias("docs_"))
        .filter(F.col("docs_") > min_docs)
        .join(within_bound(hosts, hosts.count()), "host_")
        .filter(F.col("docs_") > most)
        .select("host_", "hash")
    )
    removed = (
        lines.join(within_bound(frequent, frequent.count()), ["host_", "hash"], "left_semi")
        .groupBy("row_")
        .agg(F.sum("words").alias("removed_"))
    )
    n = F.col("n_words")
    failed = (n < 50) | (100 * F.col("n_repeat_words") > 50 * n)
    depleted = F.col("n_removed_words") > F.lit(float(max_removed)) * n
    return (
        rows.join(removed, "row_", "left")
        .withColumn("n_removed_words", F.coalesce("removed_", F.lit(0)).cast("long"))
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & ~depleted)
        .select(*[F.col(f"`{c}`") for c in others], *made)
    )


def op2_line_frequency(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return judge_lines(docs).drop("source")


_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
_LOW = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789', 'abcdefghijklmnopqrstuvwxyz000000000')"

OP2_SQL = rf"""
WITH docs AS (
    SELECT row_number() OVER () AS row_no, doc_id, coalesce(source, '') AS host,
           source IS NULL AS no_host, coalesce(text, '') AS text,
           {_WORDS.format("coalesce(text, '')")} AS words
    FROM documents
),
word AS (
    SELECT row_no, generate_subscripts(words, 1) AS nth, unnest(words) AS word FROM docs
),
windows AS (
    SELECT row_no, nth, word || chr(10) || lead(word) OVER w || chr(10) || lead(word, 2) OVER w AS three
    FROM word WINDOW w AS (PARTITION BY row_no ORDER BY nth)
),
twice AS (
    SELECT row_no, nth FROM windows WHERE three IS NOT NULL
    QUALIFY count(*) OVER (PARTITION BY row_no, three) > 1
),
repeated AS (
    SELECT row_no, count(DISTINCT nth + shift) AS n_repeat_words
    FROM twice, (VALUES (0), (1), (2)) s(shift) GROUP BY row_no
),
line AS (
    SELECT row_no, host, no_host, text, unnest(string_split(text, chr(10))) AS raw FROM docs
),
normal AS (
    SELECT *, {_WORDS.format(_LOW.format("raw"))} AS parts
    FROM line WHERE regexp_matches(raw, '[^\x20\x09-\x0D]')
),
per_line AS (
    SELECT row_no, host, no_host, text, array_to_string(parts, ' ') AS line,
           sum(len(parts)) AS n
    FROM normal GROUP BY ALL
),
dups AS (
    SELECT row_no, count(*) - count(DISTINCT raw) AS n_dup_lines FROM normal GROUP BY row_no
),
hosts AS (
    SELECT host, no_host, count(DISTINCT text) AS host_docs FROM docs GROUP BY ALL
),
frequent AS (
    SELECT host, no_host, line FROM per_line JOIN hosts USING (host, no_host)
    GROUP BY host, no_host, line, host_docs
    HAVING count(DISTINCT text) > greatest(20, 0.1 * host_docs)
),
removed AS (
    SELECT row_no, sum(n) AS n FROM per_line JOIN frequent USING (host, no_host, line)
    GROUP BY row_no
),
base AS (
    SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
           length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
           coalesce(n_dup_lines, 0) AS n_dup_lines,
           coalesce(n_repeat_words, 0) AS n_repeat_words,
           CAST(coalesce(n, 0) AS BIGINT) AS n_removed_words
    FROM docs LEFT JOIN dups USING (row_no) LEFT JOIN repeated USING (row_no)
         LEFT JOIN removed USING (row_no)
),
failed AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base
)
SELECT *, NOT base_failed AND n_removed_words <= 0.5 * n_words AS kept FROM failed"""
