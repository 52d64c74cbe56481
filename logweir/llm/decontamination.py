"""Benchmark decontamination with a distributed positional inverted index.

The index is a stored table of postings (term, row, position). It is split by
document, like the shards of a search engine, so it is built without any shuffle;
within a file a term's postings lie together, which lets Parquet skip the others.
It holds all postings of the terms given, normally the words of the benchmark.

A phrase is looked up from its rarest term: that term's postings, less the term's
place in the phrase, are the possible starts. They are intersected with the offset
list of the next rarest term, and the few that are left with all others. With
``slop`` a term may stand that many places off (a proximity match).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logweir.llm.common import run_folder, stored, table, within_bound

WINDOW = 10
# Not ASCII, or a digit or letter.
TOKEN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# The posting at position 0 of every row, which stands for the row itself.
HEADER = 0


def tokens(text: Column) -> Column:
    """Words of a text after A-Z became a-z; none for null."""
    low = F.translate(text, UPPER, UPPER.lower())
    found = F.regexp_extract_all(low, F.lit(TOKEN), F.lit(0))
    return F.coalesce(found, F.array().cast("array<string>"))


def term_ids(words: DataFrame) -> DataFrame:
    """Distinct values of ``term`` with a 64-bit ``term_id``; no two share one."""
    terms = stored(
        words.select("term").distinct().withColumn("term_id", F.xxhash64("term"))
    )
    rows, ids = terms.agg(F.count(F.lit(1)), F.count_distinct("term_id")).first()
    if rows != ids or not terms.filter(F.col("term_id") == HEADER).isEmpty():
        raise ValueError("two terms share a 64-bit hash; take another hash")
    return terms


def build_index(
    docs: DataFrame, terms: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The stored postings of ``terms`` (term, term_id) in ``docs``.

    Columns row_id, term_id, pos (from 1), and for the row's header posting
    (term_id 0, pos 0) doc_id, text_hash and n_words. Every row of ``docs`` is a
    document of its own, also with a null or repeated id; null texts have no words.
    """
    header = docs.sparkSession.createDataFrame([("", HEADER)], "term string, term_id long")
    known = terms.select("term", "term_id")
    known = within_bound(known.union(header), known.count() + 1)
    words = docs.select(
        F.monotonically_increasing_id().alias("row_id"),
        F.col(id_col).alias("doc_id"),
        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_hash"),
        F.concat(F.array(F.lit("")), tokens(F.col(text_col))).alias("words"),
    )
    at_head = F.col("pos") == 0
    postings = (
        words.select(
            "row_id",
            "doc_id",
            "text_hash",
            (F.size("words") - 1).cast("long").alias("n_words"),
            F.posexplode("words").alias("pos", "term"),
        )
        .join(known, "term")
        .select(
            "row_id",
            "term_id",
            "pos",
            F.when(at_head, F.col("doc_id")).alias("doc_id"),
            F.when(at_head, F.col("text_hash")).alias("text_hash"),
            F.when(at_head, F.col("n_words")).alias("n_words"),
        )
    )
    path = run_folder(docs.sparkSession)
    postings.sortWithinPartitions("term_id", "row_id", "pos").write.parquet(path)
    return docs.sparkSession.read.schema(postings.schema).parquet(path)


def headers(index: DataFrame) -> DataFrame:
    """One row per indexed document: row_id, doc_id, text_hash, n_words."""
    return index.filter(F.col("term_id") == HEADER).drop("term_id", "pos")


def windows(items: DataFrame, size: int = WINDOW) -> DataFrame:
    """Stored phrases (phrase, item_no, item_id, words) of ``size`` words each.

    A shorter item is one phrase whole; one without words gives none.
    """
    numbered = items.select(
        F.monotonically_increasing_id().alias("item_no"),
        "item_id",
        tokens(F.col("text")).alias("words"),
    ).filter(F.size("words") > 0)
    last = F.greatest(F.lit(0), F.size("words") - size)
    started = numbered.withColumn("start", F.explode(F.sequence(F.lit(0), last)))
    return stored(
        started.select(
            F.monotonically_increasing_id().alias("phrase"),
            "item_no",
            "item_id",
            F.slice("words", F.col("start") + 1, size).alias("words"),
        )
    )


def find(index: DataFrame, phrases: DataFrame, terms: DataFrame, slop: int = 0) -> DataFrame:
    """Matches (phrase, row_id, start, length) of ``phrases`` (phrase, words).

    With ``slop`` 0 these are exact phrase matches; else every word has to be
    within ``slop`` places of its own, reckoned from the rarest word's.
    """
    counts = index.filter(F.col("term_id") != HEADER).groupBy("term_id").agg(
        F.count(F.lit(1)).alias("n")
    )
    placed = (
        phrases.select(
            "phrase",
            F.size("words").alias("length"),
            F.posexplode("words").alias("offset", "term"),
        )
        .join(terms, "term")
        .join(counts, "term_id", "left")
    )
    whole = Window.partitionBy("phrase")
    ranked = stored(
        placed.withColumn("least_", F.min(F.coalesce("n", F.lit(0))).over(whole))
        .filter("least_ > 0")
        .withColumn("rank", F.row_number().over(whole.orderBy("n", "offset")))
        .select("phrase", "length", "term_id", "offset", "rank")
    )
    rows = ranked.count()

    def of_rank(condition: str) -> DataFrame:
        return within_bound(ranked.filter(condition), rows)

    starts = (
        index.join(of_rank("rank = 1"), "term_id")
        .withColumn("start", F.col("pos") - F.col("offset"))
        .filter("start >= 1" if not slop else "pos >= 1")
        .select("phrase", "length", "row_id", "start")
    )

    places = F.array(*[F.lit(d) for d in range(-slop, slop + 1)])

    def intersect(starts: DataFrame, ranks: str, postings: DataFrame) -> DataFrame:
        """Starts at which all terms of these ranks stand."""
        asked = (
            starts.join(of_rank(ranks), ["phrase", "length"])
            .withColumn("off_", F.explode(places))
            .withColumn("pos", F.col("start") + F.col("offset") + F.col("off_"))
        )
        return (
            asked.join(postings, ["term_id", "row_id", "pos"], "left_semi")
            .groupBy("phrase", "length", "row_id", "start")
            .agg(F.count_distinct("offset").alias("found_"))
            .filter(F.col("found_") == (F.lit(1) if ranks == "rank = 2" else F.col("length") - 2))
            .drop("found_")
        )

    postings = index.select("term_id", "row_id", "pos")
    second = of_rank("rank = 2").select("term_id").distinct()
    second = postings.join(within_bound(second, rows), "term_id", "left_semi")
    longer = starts.filter("length > 1")
    two = stored(intersect(longer, "rank = 2", second))
    left = two.select("row_id").distinct()
    left = within_bound(left, left.count())
    third = postings.join(left, "row_id", "left_semi")
    rest = intersect(two.filter("length > 2"), "rank > 2", third)
    columns = ["phrase", "row_id", "start", "length"]
    matches = starts.filter("length = 1").select(columns)
    matches = matches.union(two.filter("length = 2").select(columns))
    return stored(matches.union(rest.select(columns)))


def contamination(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_hash, n_words, n_hit, item_ids.

    n_hit counts the words inside any occurrence of a window of an item; item_ids
    are the ids of items with such windows, as sorted strings. Items that share an
    id count once; items without id mark words but are not listed. Null texts have
    no words, empty tables give no hits. Further columns are not looked at.
    """
    phrases = windows(items, size)
    terms = term_ids(phrases.select(F.explode("words").alias("term")))
    index = build_index(docs, terms)
    found = find(index, phrases, terms)
    hit = (
        found.select(
            "row_id", F.explode(F.expr("sequence(start, start + length - 1)")).alias("pos")
        )
        .distinct()
        .groupBy("row_id")
        .agg(F.count(F.lit(1)).alias("n_hit"))
    )
    names = phrases.select("phrase", F.col("item_id").cast("string").alias("item"))
    listed = (
        found.join(names, "phrase")
        .select("row_id", "item")
        .distinct()
        .groupBy("row_id")
        .agg(F.sort_array(F.collect_list("item")).alias("item_ids"))
    )
    return (
        headers(index)
        .join(hit, "row_id", "left")
        .join(listed, "row_id", "left")
        .select(
            "doc_id",
            "text_hash",
            "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        )
    )


def decontaminate(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` that hold no window of any item."""
    bad = stored(
        contamination(docs, items, size)
        .filter("n_hit > 0")
        .select(F.col("doc_id").alias("doc_id_"), F.col("text_hash").alias("text_hash_"))
        .distinct()
    )
    same = F.expr("doc_id <=> doc_id_ AND xxhash64(coalesce(text, '')) = text_hash_")
    return docs.join(within_bound(bad, bad.count()), same, "left_anti")


def op6_positional_index(spark, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


_TOKENS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

OP6_SQL = rf"""
WITH docs AS (
    SELECT row_number() OVER () AS row_no, doc_id, {_TOKENS} AS words FROM documents
),
items AS (
    SELECT item_id, {_TOKENS} AS words FROM benchmark
),
parts AS (
    SELECT item_id, list_slice(words, s, s + 9) AS part
    FROM items, LATERAL (SELECT unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS s)
    WHERE len(words) > 0
),
sizes AS (SELECT DISTINCT len(part) AS size FROM parts),
places AS (
    SELECT row_no, s, size, list_slice(words, s, s + size - 1) AS part
    FROM (SELECT row_no, size, words, unnest(range(1, len(words) - size + 2)) AS s
          FROM docs, sizes WHERE len(words) >= size)
),
found AS (
    SELECT row_no, s, size, item_id FROM places JOIN parts USING (part)
),
hit AS (
    SELECT row_no, count(DISTINCT word) AS n_hit
    FROM (SELECT row_no, unnest(range(s, s + size)) AS word FROM found) GROUP BY row_no
),
listed AS (
    SELECT row_no, count(DISTINCT item_id) AS n_items,
           string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
    FROM found GROUP BY row_no
)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (row_no) LEFT JOIN listed USING (row_no)"""
