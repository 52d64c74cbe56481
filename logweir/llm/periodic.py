"""Periodic runs of words, found by recompression.

A run is a stretch of words with smallest period q, at least ``max(12, 2 * q)`` long,
that cannot be extended keeping q. Such a stretch has at least q places in a row whose
word equals the one q places on; one of them is a multiple of q. So the candidates of
period q are the pairs (k * q, (k + 1) * q) of a text with equal words, about n * ln(n)
pairs for all periods; how far they agree to the right and to the left gives the run.

These extensions come from a run-length grammar of the texts, built by turns: blocks
of one symbol become one symbol, then neighbours of a left and a right class become
one. Where a cut falls depends on the two symbols beside it alone, so equal stretches
are compressed alike but for their ends. An extension is found by climbing the levels
while symbols agree and coming down where they differ, a few steps a level, for all
candidates of a slice of texts at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweir.llm.bytewords import SPACES, Words, split_words, steps
from logweir.llm.common import WORD, table, with_fields

MIN_LENGTH = 12
STEP_BYTES = 2 << 20
# Candidates that are extended at once.
MAX_PAIRS = 1 << 21
# The grammar ends when no text has more symbols; the rest is compared one by one.
TOP_SYMBOLS = 4

RUNS = "array<struct<start: long, length: long, period: long>>"


@dataclass
class Level:
    """Symbols of one level, and how the next one groups them.

    Group ``p`` of the next level has the symbols from ``first[p]`` to
    ``first[p + 1] - 1``; ``parent`` is the group of each symbol.
    """

    symbols: np.ndarray
    parent: np.ndarray | None = None
    first: np.ndarray | None = None
    blocks: bool = False


def _named(keys: np.ndarray) -> np.ndarray:
    return pd.factorize(keys)[0].astype("int32")


def _group(level: Level, opens: np.ndarray, second: np.ndarray | None) -> np.ndarray:
    """Fill in the grouping that begins a group at ``opens``; the next symbols."""
    begin = np.flatnonzero(opens)
    level.first = np.append(begin, len(opens)).astype("int32")
    level.parent = (np.cumsum(opens) - 1).astype("int32")
    head = level.symbols[begin].astype("int64")
    size = np.diff(level.first).astype("int64")
    if second is None:
        return _named(head * (int(size.max()) + 1) + size)
    tail = np.where(size == 2, level.symbols[np.minimum(begin + 1, len(opens) - 1)] + 1, 0)
    return _named(head * (int(level.symbols.max()) + 2) + tail)


def compress(symbols: np.ndarray) -> list[Level]:
    """The levels of the grammar, the texts' words first.

    ``symbols`` are texts with one separator, the first symbol, before, between and
    after them. A separator is never grouped.
    """
    levels = [Level(symbols.astype("int32"))]
    salt = 0
    while True:
        level = levels[-1]
        own = level.symbols
        barrier = own == own[0]
        if len(own) < 2 or np.diff(np.flatnonzero(barrier)).max() <= TOP_SYMBOLS + 1:
            return levels
        level.blocks = len(levels) % 2 == 1
        if level.blocks:
            opens = np.append(True, own[1:] != own[:-1]) | barrier
            levels.append(Level(_group(level, opens, None)))
            continue
        salt += 1
        mixed = (np.arange(int(own.max()) + 1, dtype="uint64") + np.uint64(salt)) * np.uint64(
            0x9E3779B97F4A7C15
        )
        mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        side = ((mixed >> np.uint64(40)) & np.uint64(1)).astype(bool)[own]
        inner = ~barrier[:-1] & ~barrier[1:]
        left_right = inner & side[:-1] & ~side[1:]
        right_left = inner & ~side[:-1] & side[1:]
        # The way round that shortens more.
        pairs = left_right if left_right.sum() >= right_left.sum() else right_left
        second = np.append(False, pairs)
        levels.append(Level(_group(level, ~second, second)))


def _advance(level: Level, a: np.ndarray, b: np.ndarray, step: int) -> np.ndarray:
    """By how many symbols two equal ones, with their blocks' rests, agree."""
    if not level.blocks:
        return np.ones(len(a), "int32")
    edge = level.first[1:] if step > 0 else level.first[:-1] - 1
    rest_a = (edge[level.parent[a]] - a) * step
    rest_b = (edge[level.parent[b]] - b) * step
    return np.minimum(rest_a, rest_b)


def extensions(levels: list[Level], a: np.ndarray, b: np.ndarray, step: int) -> np.ndarray:
    """How many words agree from ``a`` and ``b`` on, to the right (1) or left (-1).

    ``a`` and ``b`` are different places of one text in the first level.
    """
    begin = a
    a, b = a.astype("int32"), b.astype("int32")
    top = len(levels) - 1
    stopped = np.full(len(a), top, "int32")

    def match(height: int, who: np.ndarray) -> None:
        """Move on while symbols of this level agree."""
        level = levels[height]
        while len(who):
            who = who[level.symbols[a[who]] == level.symbols[b[who]]]
            if not len(who):
                return
            by = step if height == top else step * _advance(level, a[who], b[who], step)
            a[who] += by
            b[who] += by

    climbing = np.arange(len(a))
    for height in range(top):
        level = levels[height]
        edge = level.first[:-1] if step > 0 else level.first[1:] - 1
        waiting = climbing
        while True:
            ready = (edge[level.parent[a[waiting]]] == a[waiting]) & (
                edge[level.parent[b[waiting]]] == b[waiting]
            )
            waiting = waiting[~ready]
            if not len(waiting):
                break
            same = level.symbols[a[waiting]] == level.symbols[b[waiting]]
            stopped[waiting[~same]] = height
            waiting = waiting[same]
            by = step * _advance(level, a[waiting], b[waiting], step)
            a[waiting] += by
            b[waiting] += by
        climbing = climbing[stopped[climbing] > height]
        a[climbing] = level.parent[a[climbing]]
        b[climbing] = level.parent[b[climbing]]
    match(top, climbing)
    for height in range(top - 1, -1, -1):
        level = levels[height]
        edge = level.first[:-1] if step > 0 else level.first[1:] - 1
        falling = np.flatnonzero(stopped > height)
        a[falling] = edge[a[falling]]
        b[falling] = edge[b[falling]]
        match(height, falling)
    return (a - begin) * step


def _candidates(words: np.ndarray, bounds: np.ndarray, least: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and periods of the harmonic grids of all texts with equal words."""
    counts = np.diff(bounds)
    long_enough = np.flatnonzero(counts >= least)
    halves = counts[long_enough] // 2
    text = np.repeat(long_enough, halves)
    period = np.arange(len(text)) - np.repeat(np.cumsum(halves) - halves, halves) + 1
    pairs = (counts[text] - 1) // period
    total = np.cumsum(pairs)
    first = 0
    while first < len(text):
        done = total[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(total, done + MAX_PAIRS, "right")))
        n = pairs[first:last]
        row = np.repeat(np.arange(first, last), n)
        k = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        q = period[row]
        at = bounds[text[row]] + k * q
        same = words[at] == words[at + q]
        yield at[same], q[same]
        first = last


def runs_of(words: Words, least: int = MIN_LENGTH) -> tuple[np.ndarray, ...]:
    """Text, first word in the slice, length and period of all runs, in this order."""
    bounds, text_of = words.bounds, words.text_of
    none = tuple(np.empty(0, "int64") for _ in range(4))
    if not len(words):
        return none
    names = words.encoded().indices.to_numpy().astype("int64")
    # A separator, symbol 0, before each text and at the end.
    place = np.arange(len(names)) + text_of + 1
    string = np.zeros(len(names) + len(bounds), "int64")
    string[place] = names + 1
    levels = compress(string)
    found = []
    for at, q in _candidates(names, bounds, least):
        here = place[at]
        before = extensions(levels, here - 1, here - 1 + q, -1)
        # Otherwise the grid point before gives the same run.
        own = before < q
        at, q, before, here = at[own], q[own], before[own], here[own]
        length = before + extensions(levels, here, here + q, 1) + q
        fit = length >= np.maximum(least, 2 * q)
        found.append(np.stack([(at - before)[fit], length[fit], q[fit]]))
    if not found:
        return none
    start, length, period = np.concatenate(found, axis=1)
    order = np.lexsort([period, length, start])
    start, length, period = start[order], length[order], period[order]
    # Multiples of a period give the same stretch; the smallest stands first.
    again = (start[1:] == start[:-1]) & (length[1:] == length[:-1])
    smallest = ~np.append(False, again)[: len(start)]
    start, length, period = start[smallest], length[smallest], period[smallest]
    order = np.lexsort([period, start])
    start, length, period = start[order], length[order], period[order]
    return text_of[start], start, length, period


def collapsed_texts(words: Words, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> list[bytes]:
    """Each text without the words that repeat a run's first period."""
    change = np.zeros(len(words) + 1, "int64")
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    keep = np.cumsum(change[:-1]) == 0
    out = []
    for first, last in zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist(), strict=True):
        own = keep[first:last]
        out.append(words.joined(first, last) if own.all() else words.kept(first, last, own))
    return out


def find_runs(docs: DataFrame, min_length: int = MIN_LENGTH, text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``runs`` and ``collapsed``.

    runs has start (a word's number from 0), length and period of every run, by start
    and period; collapsed has the words that no run contains after its first period,
    with one space between them. A null or empty text has no words, no runs and an
    empty collapsed text. Rows are judged one by one, so repeated rows and ids do not
    matter. Older columns of these names are replaced, all others kept. A text is
    searched whole in one task, in memory proportional to its words.
    """
    made = ["n_words", "runs", "collapsed"]
    docs = docs.drop(*made)
    names = [*docs.columns, *made]
    schema = with_fields(docs, n_words="long", runs=RUNS, collapsed="string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, text_col, STEP_BYTES):
                words = split_words(part.column(text_col), SPACES)
                text, start, length, period = runs_of(words, min_length)
                inner = pa.StructArray.from_arrays(
                    [pa.array(start - words.bounds[text]), pa.array(length), pa.array(period)],
                    ["start", "length", "period"],
                )
                ends = np.searchsorted(text, np.arange(part.num_rows + 1)).astype("int32")
                texts = pa.array(collapsed_texts(words, start, length, period), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.columns,
                        pa.array(words.counts),
                        pa.ListArray.from_arrays(pa.array(ends), inner),
                        texts.cast(pa.string()),
                    ],
                    names,
                )

    return docs.mapInArrow(run, schema)


def planted(docs: DataFrame) -> DataFrame:
    """One document in ten, by its id's CRC, repeats some of its words to its end."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(F.col("h_") / 10)
    n = F.size("words_").cast("long")
    a = F.when(n > 0, g % n)
    p = F.floor((n - F.col("a_")) / (g % 8 + 3)) + 1

    def source(i: Column) -> Column:
        i = i.cast("long")
        from_a = F.col("a_") + (i - F.col("a_")) % F.col("p_")
        return F.get("words_", F.when(i < F.col("a_"), i).otherwise(from_a).cast("int"))

    tenth = F.when(F.col("h_") % 10 == 0, F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    return (
        docs.withColumn("h_", h)
        .withColumn("words_", tenth)
        .withColumn("a_", a)
        .withColumn("p_", p)
        .withColumn(
            "text",
            F.when(n > 0, F.array_join(F.transform("words_", lambda _, i: source(i)), " ")).otherwise(
                F.col("text")
            ),
        )
        .drop("h_", "words_", "a_", "p_")
    )


def op11_recompression_runs(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    line = F.transform(
        "runs", lambda r: F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period")))
    )
    best = F.array_max(
        F.transform(
            "runs",
            lambda r: F.struct(
                r.length.alias("length"), (-r.start).alias("start"), (-r.period).alias("period")
            ),
        )
    )
    found = find_runs(planted(docs)).withColumn("best", best)
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.floor(1000 * F.col("best.length") / -F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(line, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias(
            "runs_sha256"
        ),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


# DuckDB has no CRC-32; that of an id is folded digit by digit. Every pair of equal
# words of a text is listed, and neighbouring pairs of one distance are joined up.
OP11_SQL = r"""
WITH codes AS (
    SELECT list(list_reduce([i::UBIGINT] || [x::UBIGINT FOR x IN range(8)],
        lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END)
        ORDER BY i) AS t
    FROM range(256) r(i)
),
given AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
        CASE WHEN doc_id IS NOT NULL THEN xor(list_reduce([4294967295::UBIGINT]
            || [ascii(x)::UBIGINT FOR x IN string_split(doc_id::VARCHAR, '')],
            lambda c, y: xor(t[(xor(c, y) & 255)::BIGINT + 1], c >> 8)), 4294967295::UBIGINT)::BIGINT END AS h
    FROM documents, codes
),
shaped AS (
    SELECT doc_id, w, len(w) AS n, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a, h // 10 AS g
    FROM given
),
d AS (
    SELECT doc_id, n, CASE WHEN a IS NULL THEN w ELSE
        [w[CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END + 1] FOR i IN range(n)]
        END AS w
    FROM shaped
),
u AS (SELECT doc_id, unnest(w) AS word, unnest(range(n)) AS i FROM d),
pairs AS (
    SELECT x.doc_id, x.i, y.i - x.i AS q FROM u x JOIN u y
    ON x.doc_id = y.doc_id AND x.word = y.word AND x.i < y.i
),
islands AS (
    SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM pairs
),
stretches AS (
    SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM islands
    GROUP BY doc_id, q, island HAVING count(*) + q >= greatest(12, 2 * q)
),
runs AS (
    SELECT doc_id, start, length, min(q) AS period FROM stretches GROUP BY doc_id, start, length
),
told AS (
    SELECT doc_id, count(*) AS n_runs,
        string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines
    FROM runs GROUP BY doc_id
),
best AS (
    SELECT * FROM runs
    QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length DESC, start, period) = 1
),
dropped AS (
    SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs
),
kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS collapsed FROM u ANTI JOIN dropped USING (doc_id, i)
    GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period,
    (1000 * length) // period AS exponent_milli,
    sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM d LEFT JOIN told USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
