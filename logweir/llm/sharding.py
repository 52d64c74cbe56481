"""Reproducible shuffle into shards by a Feistel permutation of row numbers.

Every row gets a global number from 0 to N-1; a keyed permutation of these
numbers is the shuffle. Row number ``r`` lands at ``p = permute(r)``, which is
slot ``p // shards`` of shard ``p % shards``. Shard sizes differ by one at most,
slots have no gaps, and ``locate`` finds a row's place without any table.

The network works on pairs from an a x b grid that just holds N, so fewer than
2 * sqrt(N) of its points lie outside. The walk along the cycle of such a point
ends within that many steps, and only about 2 / sqrt(N) of the rows walk at all.
"""

from __future__ import annotations

import math
import struct

import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logweir.llm.common import table

ROUNDS = 4
ROWS_PER_BUCKET = 500
# Also the number of rows of the table of bucket offsets, which is broadcast.
MAX_BUCKETS = 65_536


def _grid(rows: int) -> tuple[int, int]:
    """Sides of the smallest near-square grid of at least ``rows`` points."""
    side = max(1, math.isqrt(max(rows, 1) - 1) + 1)
    return side, max(1, -(-rows // side))


def _once(x: Column, a: int, b: int, seed: int) -> Column:
    """One pass through the network, a bijection of the a * b points."""

    def mixed(half: Column, j: int, side: int) -> Column:
        return F.pmod(F.xxhash64(half, F.lit(seed + j).cast("long")), F.lit(side))

    low, high = F.pmod(x, F.lit(a)), F.floor(x / F.lit(a)).cast("long")
    for j in range(ROUNDS):
        if j % 2 == 0:
            low = F.pmod(low + mixed(high, j, a), F.lit(a))
        else:
            high = F.pmod(high + mixed(low, j, b), F.lit(b))
    return high * F.lit(a) + low


def permute(x: Column, rows: int, seed: int = 0) -> Column:
    """The place of row number ``x`` (long) in the shuffle of ``rows`` rows."""
    a, b = _grid(rows)
    first = _once(x.cast("long"), a, b, seed)
    outside = a * b - rows
    if not outside:
        return first
    size = F.lit(rows).cast("long")
    walked = F.aggregate(
        F.sequence(F.lit(1), F.lit(outside)),
        first,
        lambda at, _: F.when(at < size, at).otherwise(_once(at, a, b, seed)),
    )
    return F.when(first < size, first).otherwise(walked)


def locate(row_number: int, rows: int, shards: int, seed: int = 0) -> tuple[int, int]:
    """(shard, slot) of one row number, computed without Spark."""
    if not 0 <= row_number < rows:
        raise ValueError("row_number must be in [0, rows)")

    def mixed(half: int, j: int, side: int) -> int:
        value = 42  # Spark's seed
        for part in (half, seed + j):
            value = xxhash.xxh64_intdigest(struct.pack("<q", part), value)
        return (value - (1 << 64) if value >> 63 else value) % side

    a, b = _grid(rows)
    at = row_number
    while True:
        low, high = at % a, at // a
        for j in range(ROUNDS):
            if j % 2 == 0:
                low = (low + mixed(high, j, a)) % a
            else:
                high = (high + mixed(low, j, b)) % b
        at = high * a + low
        if at < rows:
            return at % shards, at // shards


def with_row_number(
    docs: DataFrame, rows: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Add ``row_number_`` from 0, in an order that only ids and texts decide.

    Rows fall into hashed buckets, are sorted inside them and offset by the sizes
    of the buckets before. The order does not depend on files or partitions. Rows
    with equal id and text are interchangeable.
    """
    buckets = min(MAX_BUCKETS, max(1, -(-rows // ROWS_PER_BUCKET)))
    text_hash = F.xxhash64(text_col)
    keyed = docs.withColumn("text_hash_", text_hash).withColumn(
        "bucket_",
        F.pmod(F.xxhash64(id_col, "text_hash_"), F.lit(buckets)).cast("int"),
    )
    sizes = (
        docs.select(id_col, text_hash.alias("text_hash_"))
        .groupBy(
            F.pmod(F.xxhash64(id_col, "text_hash_"), F.lit(buckets))
            .cast("int")
            .alias("bucket_")
        )
        .agg(F.count(F.lit(1)).alias("rows_"))
    )
    before = Window.orderBy("bucket_").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "bucket_", F.coalesce(F.sum("rows_").over(before), F.lit(0)).alias("offset_")
    )
    inside = Window.partitionBy("bucket_").orderBy(id_col, "text_hash_")
    return (
        keyed.withColumn("inside_", F.row_number().over(inside))
        .join(F.broadcast(offsets), "bucket_")
        .withColumn("row_number_", F.col("offset_") + F.col("inside_") - 1)
        .drop("bucket_", "inside_", "offset_", "text_hash_")
    )


def shard(
    docs: DataFrame,
    shards: int = 24,
    seed: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``docs`` with ``shard`` (int) and ``slot`` (long).

    Null ids and texts hash and sort like any value; an empty table gives an empty
    one; repeated rows get places of their own. Further columns are kept; an older
    ``shard`` or ``slot`` column is replaced, names ending in ``_`` are reserved.
    """
    if shards <= 0:
        raise ValueError("shards must be positive")
    rows = docs.count()
    docs = docs.drop("shard", "slot")
    place = permute(F.col("row_number_"), rows, seed)
    return (
        with_row_number(docs, rows, id_col, text_col)
        .withColumn("place_", place)
        .withColumn("shard", F.pmod("place_", F.lit(shards)).cast("int"))
        .withColumn("slot", F.floor(F.col("place_") / F.lit(shards)).cast("long"))
        .drop("row_number_", "place_")
    )


def op9_feistel_shards(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    text = F.coalesce("text", F.lit(""))
    narrow = docs.select(
        "doc_id",
        F.xxhash64("text").alias("text"),
        (F.octet_length(text) + F.lit(8)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    return shard(narrow).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
