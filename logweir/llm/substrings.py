"""Removal of passages that repeat across documents, by prefix-partitioned suffix trees.

A window is a number of consecutive words; a word goes if a window that covers it also
starts in a document with a smaller id. Windows are suffixes cut at a fixed depth, and
equal ones are the leaves below one internal node of that depth or more.

* Suffixes fall into groups by a prefix that all equal windows share. A window's anchor
  is the place in it whose next ten words have the smallest hash; windows with the same
  anchor are neighbouring suffixes, and go as one record with the words they span. The
  prefix of the last of them (all windows contain it) is the key: ten words at least.
* Only prefixes that occur in two documents go on. They are counted first, on hashes
  alone, with counts combined in tasks.
* A group above a memory bound is split by longer prefixes: its windows are parted by
  their distance from the anchor, so that those of a part share forty words and more;
  what is still too large is split by whole windows, where a node is just a key and
  its smallest document id is an aggregate.
* Each task builds the subtrees of many groups at once. Suffixes are ranked by prefixes
  of 1, 2, 4, ... words, each from two ranks of half the length, up to the window. Runs
  of one rank are the deep nodes.

Texts with the same words are one text: the copy with the smallest id stands for all.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweir.llm.bytewords import SPACES, Words, split_words, steps
from logweir.llm.common import sorted_runs, stored, table, with_fields
from logweir.llm.skew import join_dealt

WINDOW = 50
# Words of the shortest prefix.
CORE = 10
# Records that one subtree is built from, at most.
MAX_RECORDS = 4_000
# Windows of one record after a split.
SPLIT_WINDOWS = 10
# Words of all subtrees that a task builds at once; a single group may have more.
STEP_WORDS = 1_000_000

_LAST_ID = (1 << 63) - 1


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def word_hashes(words: Words) -> np.ndarray:
    names = words.encoded()
    distinct = names.dictionary.to_pylist()
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, distinct), "uint64", len(distinct))
    return hashed[names.indices.to_numpy()]


def stretch_hashes(hashed: np.ndarray, size: int) -> np.ndarray:
    """A hash of each ``size`` neighbouring words."""
    out = np.zeros(max(len(hashed) - size + 1, 0), "uint64")
    for k in range(size):
        out = out * np.uint64(0x9E3779B97F4A7C15) + hashed[k : k + len(out)]
    return _mixed(out)


def window_anchors(cores: np.ndarray, reach: int) -> np.ndarray:
    """For each place the first smallest of the next ``reach`` cores."""
    least, at, width = cores, np.arange(len(cores)), 1

    def merged(shift: int) -> tuple[np.ndarray, np.ndarray]:
        left = least[:-shift] <= least[shift:]
        return np.where(left, least[:-shift], least[shift:]), np.where(left, at[:-shift], at[shift:])

    while width * 2 <= reach:
        least, at = merged(width)
        width *= 2
    return merged(reach - width)[1] if reach > width else at


@dataclass
class Records:
    """Neighbouring windows of one anchor: ``count`` of them from word ``first`` on."""

    text: np.ndarray
    first: np.ndarray
    count: np.ndarray
    anchor: np.ndarray
    key: np.ndarray


def find_records(words: Words, hashed: np.ndarray, window: int = WINDOW, core: int = CORE) -> Records:
    none = np.empty(0, "int64")
    if len(words) < window:
        return Records(none, none, none, none, none)
    cores = stretch_hashes(hashed, core)
    at = window_anchors(cores, window - core + 1)
    text_of = words.text_of
    starts = np.arange(len(words) - window + 1)
    inside = text_of[starts] == text_of[starts + window - 1]
    starts, at = starts[inside], at[starts[inside]]
    if not len(starts):
        return Records(none, none, none, none, none)
    opens = np.append(True, (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1))
    begin = np.flatnonzero(opens)
    count = np.diff(np.append(begin, len(starts)))
    anchor = at[begin]
    return Records(text_of[starts[begin]], starts[begin], count, anchor, cores[anchor].view("int64"))


def split_by_distance(
    records: Records, which: np.ndarray, words: Words, window: int, core: int
) -> Iterator[tuple[int, int, int, int]]:
    """Parts of the given records: record, first window, count, key.

    Windows at 0-9, 10-19, ... words before the anchor make a part; they share the
    words from the part's last window to the end of its first, which are the key.
    """
    for r in which.tolist():
        anchor, first, count = records.anchor[r], records.first[r], records.count[r]
        near, far = anchor - (first + count - 1), anchor - first
        for part in range(near // SPLIT_WINDOWS, far // SPLIT_WINDOWS + 1):
            low = part * SPLIT_WINDOWS
            high = min(low + SPLIT_WINDOWS - 1, window - core)
            start, stop = max(first, anchor - high), min(first + count - 1, anchor - low)
            shared = words.joined(anchor - low, anchor + window - high)
            key = xxhash.xxh3_64_intdigest(shared, seed=part + 1)
            yield r, int(start), int(stop - start + 1), key - (1 << 64) if key >> 63 else key


def repeated_windows(contexts: pa.Array, counts: np.ndarray, ids: np.ndarray, window: int) -> tuple:
    """Which windows of these records also start under a smaller id.

    Returns the record and the place in it of each such window. Suffixes are ranked
    by doubling; suffixes of one rank at depth ``window`` lie below one node, of which
    only the smallest id matters.
    """
    words = split_words(contexts, SPACES)
    rank = words.encoded().indices.to_numpy().astype("int64")
    width = 1
    while width < window:
        shift = min(width, window - width)
        if len(rank) <= shift:
            break
        pairs = rank[:-shift] * (int(rank.max()) + 1) + rank[shift:]
        rank = pd.factorize(pairs, sort=True)[0].astype("int64")
        width += shift
    record = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(len(record)) - np.repeat(np.cumsum(counts) - counts, counts)
    node = rank[words.bounds[:-1][record] + place]
    smallest = np.full(int(node.max()) + 1 if len(node) else 0, _LAST_ID)
    np.minimum.at(smallest, node, ids[record])
    again = ids[record] > smallest[node]
    return record[again], place[again]


# --- the rows of the corpus ------------------------------------------------------


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Ids as numbers, a null one largest, and 128 bits that stand for the text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.withColumn(
        "id_", F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST_ID))
    ).withColumn("digest_", F.substring(F.unhex(F.sha2(text, 256)), 1, 16))


def _row() -> Column:
    """Of two rows with one hash, each just looks up the other's prefixes as well."""
    return F.xxhash64("id_", "digest_")


def outline(keyed: DataFrame, text_col: str, window: int = WINDOW, core: int = CORE) -> DataFrame:
    """``id_, digest_, n_words, words_`` (a hash of the words), ``keys_`` (prefixes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, text_col):
                words = split_words(part.column(text_col), SPACES)
                records = find_records(words, word_hashes(words), window, core)
                pairs = pd.DataFrame({"t": records.text, "k": records.key}).drop_duplicates()
                ends = np.searchsorted(pairs["t"], np.arange(part.num_rows + 1)).astype("int32")
                hashes = [
                    xxhash.xxh3_128_digest(words.joined(a, b))
                    for a, b in zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist(), strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id_"),
                        part.column("digest_"),
                        pa.array(words.counts),
                        pa.array(hashes, pa.binary()),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(pairs["k"].to_numpy("int64"))),
                    ],
                    ["id_", "digest_", "n_words", "words_", "keys_"],
                )

    schema = "id_ long, digest_ binary, n_words long, words_ binary, keys_ array<long>"
    return keyed.select("id_", "digest_", text_col).mapInArrow(run, schema)


_RECORDS = (
    "key long, split boolean, id_ long, digest_ binary, firsts array<int>, windows int, context string"
)


def _suffix_records(texts: DataFrame, text_col: str, window: int, core: int) -> DataFrame:
    """Records of the prefixes in ``shared_``; those in ``large_`` in parts.

    Equal records of one text, as a periodic text has, go once, with all their places.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, text_col):
                words = split_words(part.column(text_col), SPACES)
                records = find_records(words, word_hashes(words), window, core)
                ends = np.searchsorted(records.text, np.arange(part.num_rows + 1))
                rows: dict[tuple, list[int]] = {}
                shared, large = part.column("shared_"), part.column("large_")
                for t in range(part.num_rows):
                    own = np.arange(ends[t], ends[t + 1])
                    keys = records.key[own]
                    whole = own[np.isin(keys, shared[t].values.to_numpy())]
                    cut = own[np.isin(keys, large[t].values.to_numpy())]
                    found = [
                        (False, int(records.first[r]), int(records.count[r]), int(records.key[r]))
                        for r in whole.tolist()
                    ]
                    parts = split_by_distance(records, cut, words, window, core)
                    found += [(True, *piece[1:]) for piece in parts]
                    base = int(words.bounds[t])
                    for split, first, count, key in found:
                        context = words.joined(first, first + count + window - 1)
                        rows.setdefault((t, split, key, count, context), []).append(first - base)
                if not rows:
                    continue
                t, split, key, count, context = map(list, zip(*rows, strict=True))
                at = pa.array(t)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(key, pa.int64()),
                        pa.array(split),
                        part.column("id_").take(at),
                        part.column("digest_").take(at),
                        pa.array(list(rows.values()), pa.list_(pa.int32())),
                        pa.array(count, pa.int32()),
                        pa.array(context, pa.binary()).cast(pa.string()),
                    ],
                    ["key", "split", "id_", "digest_", "firsts", "windows", "context"],
                )

    return texts.select("id_", "digest_", text_col, "shared_", "large_").mapInArrow(run, _RECORDS)


_SPANS = "id_ long, digest_ binary, begin long, end long"


def _spans_batch(rows: pa.Table, record: np.ndarray, place: np.ndarray, window: int) -> pa.RecordBatch:
    """Words covered by the given windows, one row for each stretch of them."""
    opens = np.append(True, (record[1:] != record[:-1]) | (place[1:] != place[:-1] + 1))
    begin = np.flatnonzero(opens[: len(record)])
    last = np.append(begin[1:], len(record))[: len(begin)] - 1
    of = record[begin]
    firsts = rows.column("firsts").combine_chunks().take(pa.array(of))
    n = np.diff(firsts.offsets.to_numpy())
    at = firsts.values.slice(firsts.offsets[0].as_py(), int(n.sum())).to_numpy().astype("int64")
    low, high = np.repeat(place[begin], n), np.repeat(place[last] + window, n)
    owner = pa.array(np.repeat(of, n))
    return pa.RecordBatch.from_arrays(
        [
            rows.column("id_").combine_chunks().take(owner),
            rows.column("digest_").combine_chunks().take(owner),
            pa.array(at + low),
            pa.array(at + high),
        ],
        ["id_", "digest_", "begin", "end"],
    )


def _subtrees(records: DataFrame, window: int) -> DataFrame:
    """Spans from groups within the bound; the groups of a task are taken together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def search(tables: list[pa.Table]) -> pa.RecordBatch:
            rows = pa.concat_tables(tables)
            counts = rows.column("windows").to_numpy().astype("int64")
            ids = rows.column("id_").to_numpy()
            context = rows.column("context").combine_chunks()
            return _spans_batch(rows, *repeated_windows(context, counts, ids, window), window)

        held, size = [], 0
        for rows in sorted_runs(batches, "key"):
            held.append(rows)
            size += sum(rows.column("windows").to_numpy()) + rows.num_rows * (window - 1)
            if size >= STEP_WORDS:
                yield search(held)
                held, size = [], 0
        if held:
            yield search(held)

    grouped = records.repartition("key").sortWithinPartitions("key")
    return grouped.select("key", "id_", "digest_", "firsts", "windows", "context").mapInArrow(run, _SPANS)


def _window_keys(records: DataFrame, window: int) -> DataFrame:
    """Every window by a 128-bit hash of its words, for groups beyond the bound."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = split_words(batch.column("context"), SPACES)
            counts = batch.column("windows").to_numpy()
            record = np.repeat(np.arange(len(counts)), counts)
            place = np.arange(len(record)) - np.repeat(np.cumsum(counts) - counts, counts)
            starts = (words.bounds[:-1][record] + place).tolist()
            hashes = [xxhash.xxh3_128_digest(words.joined(s, s + window)) for s in starts]
            at = pa.array(record)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(hashes, pa.binary()),
                    batch.column("id_").take(at),
                    batch.column("digest_").take(at),
                    batch.column("firsts").take(at),
                    pa.array(place.astype("int32")),
                ],
                ["key", "id_", "digest_", "firsts", "place"],
            )

    schema = "key binary, id_ long, digest_ binary, firsts array<int>, place int"
    return records.mapInArrow(run, schema)


def repeat_spans(
    keyed: DataFrame, outlined: DataFrame, text_col: str, window: int = WINDOW, core: int = CORE,
    max_records: int = MAX_RECORDS,
) -> DataFrame:
    """``id_, digest_, spans``: the word ranges [begin, end) to remove from a text.

    ``spans`` may overlap. Rows without any are left out.
    """
    long = outlined.filter(F.col("n_words") >= window)
    total = long.count()
    copies = long.groupBy("words_").agg(F.count(F.lit(1)).alias("n"), F.min("id_").alias("first_id"))
    judged = stored(join_dealt(long, stored(copies), "words_", total).drop("words_", "n"))
    # A copy of an earlier text goes as a whole.
    whole = judged.filter("id_ > first_id").select(
        "id_", "digest_", F.lit(0).cast("long").alias("begin"), F.col("n_words").alias("end")
    )

    prefixes = judged.filter("id_ = first_id").select(
        _row().alias("row_"), "id_", F.explode("keys_").alias("key")
    )
    counted = stored(
        prefixes.groupBy("key")
        .agg(F.count(F.lit(1)).alias("n"), F.min("id_").alias("low"), F.max("id_").alias("high"))
        .filter("low < high")
        .select("key", "n")
    )
    rows = counted.agg(F.sum("n")).first()[0] or 0
    large = F.col("n") > max_records
    wanted = (
        join_dealt(prefixes.drop("id_"), counted, "key", rows)
        .groupBy("row_")
        # As many as the text itself has.
        .agg(
            F.collect_set(F.when(~large, F.col("key"))).alias("shared_"),
            F.collect_set(F.when(large, F.col("key"))).alias("large_"),
        )
    )
    texts = keyed.select("id_", "digest_", text_col).withColumn("row_", _row()).join(wanted, "row_")
    records = stored(_suffix_records(texts, text_col, window, core))

    parts = records.filter("split")
    sizes = stored(parts.groupBy("key").agg(F.count(F.lit(1)).alias("n")))
    beyond = sizes.filter(large)
    if beyond.isEmpty():
        spans = _subtrees(records, window)
    else:
        dealt = stored(join_dealt(parts, sizes, "key", sizes.agg(F.sum("n")).first()[0]))
        small = records.filter("NOT split").unionByName(dealt.filter(~large).drop("n"))
        single = stored(_window_keys(dealt.filter(large).drop("n"), window))
        nodes = stored(
            single.groupBy("key").agg(
                F.count(F.lit(1)).alias("n"), F.min("id_").alias("low"), F.max("id_").alias("high")
            )
        )
        again = join_dealt(single, nodes.filter("low < high"), "key", single.count()).filter("id_ > low")
        begin = (F.col("first") + F.col("place")).cast("long")
        spans = _subtrees(small, window).union(
            again.withColumn("first", F.explode("firsts")).select(
                "id_", "digest_", begin.alias("begin"), (begin + window).alias("end")
            )
        )
    return (
        spans.union(whole)
        .groupBy("id_", "digest_")
        .agg(F.collect_set(F.struct("begin", "end")).alias("spans"))
    )


def remove_repeats(
    docs: DataFrame,
    window: int = WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
    core: int = CORE,
    max_records: int = MAX_RECORDS,
) -> DataFrame:
    """``docs`` with ``n_words``, ``n_removed`` and ``kept_text``.

    A word goes if a window that covers it also starts in a row with a smaller id, in
    any row of it. Repeats inside one id stay. Ids are whole numbers; a null id counts
    as larger than all others. Null, empty and short texts have no windows and keep
    their words; kept words are joined by one space. Repeated rows get equal results.
    Older columns of these names are replaced, all others kept; names ending in ``_``
    are reserved. A text is held whole in one task.
    """
    made = ["n_words", "n_removed", "kept_text"]
    keyed = _keyed(docs.drop(*made), id_col, text_col)
    outlined = stored(outline(keyed, text_col, window, core))
    spans = repeat_spans(keyed, outlined, text_col, window, core, max_records)
    spans = spans.withColumnRenamed("spans", "removed_spans_")
    plain = [name for name in docs.columns if name not in made]
    none = F.array().cast("array<struct<begin: long, end: long>>")
    joined = keyed.join(spans, ["id_", "digest_"], "left").select(
        *plain, F.coalesce("removed_spans_", none).alias("spans_")
    )
    names = [*plain, *made]
    schema = with_fields(docs.select(*plain), n_words="long", n_removed="long", kept_text="string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, text_col):
                words = split_words(part.column(text_col), SPACES)
                inner = part.column("spans_").flatten()
                base = np.repeat(words.bounds[:-1], pc.list_value_length(part.column("spans_")))
                change = np.zeros(len(words) + 1, "int64")
                np.add.at(change, base + inner.field("begin").to_numpy(), 1)
                np.add.at(change, base + inner.field("end").to_numpy(), -1)
                keep = np.cumsum(change[:-1]) == 0
                kept, removed = [], []
                for a, b in zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist(), strict=True):
                    own = keep[a:b]
                    removed.append(int(b - a - own.sum()))
                    kept.append(words.kept(a, b, own) if removed[-1] else words.joined(a, b))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(name) for name in plain),
                        pa.array(words.counts),
                        pa.array(removed, pa.int64()),
                        pa.array(kept, pa.binary()).cast(pa.string()),
                    ],
                    names,
                )

    return joined.mapInArrow(run, schema)


def op13_suffix_subtrees(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


OP13_SQL = r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
),
windows AS (
    SELECT doc_id, i, md5(array_to_string(w[i + 1:i + 50], ' ')) AS own
    FROM (SELECT doc_id, w, unnest(range(len(w) - 49)) AS i FROM d WHERE len(w) >= 50)
),
firsts AS (SELECT own, min(doc_id) AS first_doc FROM windows GROUP BY own),
again AS (SELECT doc_id, i FROM windows JOIN firsts USING (own) WHERE doc_id > first_doc),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM again),
u AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS i FROM d),
kept AS (
    SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS text
    FROM u ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed,
    sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""
