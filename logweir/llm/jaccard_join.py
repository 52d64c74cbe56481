"""Exact Jaccard self-join on word n-grams, with skips from relations between sets.

A document is the set of its distinct three-word shingles, as 64-bit hashes; two
link when their Jaccard similarity reaches ``percent``. The result names for every
document its component, so links need not be listed pair by pair:

* Equal sets form one class, found by a 128-bit digest. Only classes are joined.
* Classes that agree in half of 16 minhashes form families. Families decide only
  about the way a pair is tested; any grouping gives the same links.
* Inside a family, each set is compared with the family's pivot and then held as its
  difference from it. Sets that link with the pivot are one component at once, however
  many they are: no pair of them is tested. Only the others meet the rest of their
  family, as differences, in blocks of bounded size.
* Across families there is an index from prefix tokens to sets. Tokens are ordered
  rare first by a fixed-size sketch of their counts. A token's list is cut into
  blocks by position; block pairs whose positions and sizes leave too little room
  for the overlap are skipped whole, and so are sets of one family. Long lists, by
  their real lengths, are dealt over several tasks. Pairs that share enough of their
  prefixes are verified on the whole texts.

The order, the families and the blocks are all exact devices: no link is lost. Two
different shingles could only be confused by a 64-bit hash collision.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweir.llm.common import set_aside, sorted_runs, stored, table, with_fields, within_bound
from logweir.llm.skew import MAX_HOT_KEYS, join_dealt

PERCENT = 90
HASHES = 16  # minhashes of a set
ROUNDS = 4  # of family building, each by another minhash
SKETCH = 1 << 22  # counters of the sketch that orders tokens
STEP = 256  # a small counter of a task is told at random, as this
SHARED = 3  # by so many tokens prefixes are longer than one shared token needs
BLOCK = 512  # sets of a block
BLOCK_TOKENS = 400_000  # and their tokens, about
LIST = 4_000  # entries of a list that one task compares
SHORT = 32  # entries of a list whose pairs are found along with those of others
CACHE_WORDS = 1_000_000

_C = [np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
_ODD = np.random.default_rng(7).integers(1, 1 << 63, HASHES, dtype="uint64") | np.uint64(1)


class _Words(dict):
    """Hashes of words, kept while the worker lives and there is room."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_WORDS = _Words()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of the three-word shingles of a text.

    Only A-Z are lower-cased. One or two words are one shingle, none are none.
    """
    words = (text or "").encode().lower().split()
    n = len(words)
    if not n:
        return np.empty(0, "uint64")
    h = np.fromiter(map(_WORDS.__getitem__, words), "uint64", n)
    if n < 3:
        return _mix(np.array([(h * np.array(_C[:n])).sum() + np.uint64(n)], "uint64"))
    return np.unique(_mix(h[:-2] * _C[0] + h[1:-1] * _C[1] + h[2:] * _C[2]))


def overlap_needed(a, b, percent: int):
    """Smallest overlap of linked sets of sizes a and b."""
    return -((-percent * (a + b)) // (100 + percent))


def least_partner(n, percent: int):
    """Smallest size of a partner, which is also the smallest overlap with one."""
    return -((-percent * n) // 100)


# --- one pass over the texts: digests, minhashes, and counts for the sketch ------


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view("int64")


def told_counters(counters: np.ndarray, seen: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets a task reports, and their counts, from the ``seen`` tokens it counted.

    What stands out of the task's noise is told as it is. A smaller counter c is told as
    ``least`` with probability c / ``least``: right on average, so that a token rare in
    each task and frequent over all of them is seen, and few are told.
    """
    noise = 3 + 3 * seen // SKETCH
    step = max(least, noise + 1)
    used = np.flatnonzero(counters)
    own = counters[used].astype("int64")
    drawn = np.random.default_rng().random(len(used)) * step < own
    wanted = (own > noise) | drawn
    return used[wanted], np.where(own > noise, own, step)[wanted]


def prepared(docs: DataFrame, text_col: str) -> DataFrame:
    """``docs``, stored, with row_, n_, digest_ and minhashes_; further rows, with
    null row_, hold each task's frequent sketch counters."""
    keyed = docs.withColumn("row_", F.monotonically_increasing_id())
    names = [*keyed.columns, "n_", "digest_", "minhashes_", "buckets_", "counts_"]
    longs, least = pa.list_(pa.int64()), STEP

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters, seen, schema = np.zeros(SKETCH, "uint32"), 0, None
        for whole in batches:
            schema = whole.schema
            for start in range(0, whole.num_rows, 1024):
                batch = whole.slice(start, 1024)
                sizes, digests, minima = [], [], []
                for text in batch.column(text_col):
                    own = shingles(text.as_py())
                    sizes.append(len(own))
                    digests.append(xxhash.xxh3_128_digest(own.tobytes()))
                    if len(own):
                        np.add.at(counters, (own % np.uint64(SKETCH)).astype("int64"), 1)
                        minima.append(
                            [int(_signed((own * odd).min(keepdims=True))[0]) for odd in _ODD]
                        )
                    else:
                        minima.append(None)
                    seen += len(own)
                empty = pa.nulls(batch.num_rows, longs)
                yield pa.RecordBatch.from_arrays(
                    [
                        *batch.columns,
                        pa.array(sizes, pa.int64()),
                        pa.array(digests, pa.binary()),
                        pa.array(minima, longs),
                        empty,
                        empty,
                    ],
                    names,
                )
        if schema is not None:
            often, told = told_counters(counters, seen, least)
            yield pa.RecordBatch.from_arrays(
                [
                    *[pa.nulls(1, field.type) for field in schema],
                    pa.nulls(1, pa.int64()),
                    pa.nulls(1, pa.binary()),
                    pa.nulls(1, longs),
                    pa.array([often.tolist()], longs),
                    pa.array([told.tolist()], longs),
                ],
                names,
            )

    types = {"n_": "long", "digest_": "binary"}
    types |= {name: "array<long>" for name in ("minhashes_", "buckets_", "counts_")}
    schema = with_fields(keyed, **types)
    for field in schema:
        field.nullable = True
    return stored(keyed.mapInArrow(run, schema))


def sketch(rows: DataFrame) -> np.ndarray:
    """Summed counters; of fixed size, whatever the corpus."""
    pairs = rows.filter("row_ IS NULL").select(
        F.explode(F.arrays_zip("buckets_", "counts_")).alias("x")
    )
    total = pairs.groupBy(F.col("x.buckets_").alias("bucket")).agg(
        F.sum("x.counts_").alias("n")
    )
    counts = np.zeros(SKETCH, "int64")
    mean = (total.agg(F.sum("n")).first()[0] or 0) // SKETCH
    # Twice the mean is noise of hashing in a large corpus.
    found = total.filter(F.col("n") > max(8, 2 * mean)).toArrow()
    counts[found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    return counts


# --- families --------------------------------------------------------------------


def families(classes: DataFrame) -> DataFrame:
    """(set_, family_) for the classes that share a family with others."""
    agree = F.aggregate(
        F.zip_with("minhashes_", "pivot.minhashes_", lambda a, b: (a == b).cast("int")),
        F.lit(0),
        lambda total, one: total + one,
    )
    roots = classes.filter("n_ > 0").select("set_", "minhashes_")
    total, merged = roots.count(), None
    for j in range(ROUNDS):
        keyed = roots.withColumn("key", F.col("minhashes_")[j])
        pivots = keyed.groupBy("key").agg(
            F.min(F.struct("set_", "minhashes_")).alias("pivot"),
            F.count(F.lit(1)).alias("members"),
        )
        now = stored(
            join_dealt(keyed, stored(pivots.filter("members > 1")), "key", total, "members")
            .filter((F.col("set_") != F.col("pivot.set_")) & (agree * 2 >= HASHES))
            .select("set_", F.col("pivot.set_").alias("family_"))
        )
        merged = now if merged is None else merged.union(now)
        if j + 1 < ROUNDS:
            roots = stored(roots.join(now.select("set_"), "set_", "left_anti"))
    merged = stored(merged)
    up = merged.select(F.col("set_").alias("family_"), F.col("family_").alias("up_"))
    for _ in range(ROUNDS - 1):  # a pivot may have joined a family later
        merged = merged.join(up, "family_", "left").select(
            "set_", F.coalesce("up_", "family_").alias("family_")
        )
    merged = stored(merged)
    pivots = merged.select(F.col("family_").alias("set_"), "family_").distinct()
    return stored(merged.union(pivots))


def forest(
    ids: np.ndarray, sizes: np.ndarray, changes: list[np.ndarray], percent: int
) -> list[tuple[int, int]]:
    """Edges that connect exactly the sets connected by links.

    Sets are given by their sizes and their differences from one and the same set. With
    |x ^ y| from the two differences, |x & y| = (|x| + |y| - |x ^ y|) / 2.
    """
    order = np.argsort(ids, kind="stable")
    ids, sizes, changes = ids[order], sizes[order], [changes[i] for i in order]
    lengths = np.array([len(c) for c in changes])
    tokens, place, count = np.unique(
        np.concatenate(changes), return_inverse=True, return_counts=True
    )
    # A token in one difference only is in no intersection of differences.
    number = np.cumsum(count > 1) - 1
    owner = np.repeat(np.arange(len(ids)), lengths)
    common = count[place] > 1
    rows, columns = owner[common], number[place[common]]
    both = np.zeros((len(ids), len(ids)), "float32")
    by_column = np.argsort(columns, kind="stable")
    rows, columns = rows[by_column], columns[by_column]
    for start in range(0, int((count > 1).sum()), 2048):
        lo, hi = np.searchsorted(columns, [start, start + 2048])
        dense = np.zeros((len(ids), 2048), "float32")
        dense[rows[lo:hi], columns[lo:hi] - start] = 1
        both += dense @ dense.T
    apart = lengths[:, None] + lengths[None, :] - 2 * both.astype("int64")
    inter = (sizes[:, None] + sizes[None, :] - apart) // 2
    linked = 100 * inter >= percent * (sizes[:, None] + sizes[None, :] - inter)
    np.fill_diagonal(linked, True)
    label = np.arange(len(ids))
    while True:
        lower = np.where(linked, label[None, :], len(ids)).min(axis=1)
        lower = lower[lower]
        if (lower == label).all():
            break
        label = lower
    return [(int(ids[i]), int(ids[r])) for i, r in enumerate(label) if i != r]


def _blocks(rows, tokens):
    """How many blocks hold so many sets with so many tokens."""
    return F.greatest(
        F.lit(1), F.ceil(rows / F.lit(BLOCK)), F.ceil(tokens / F.lit(BLOCK_TOKENS))
    )


def stars(members: DataFrame, percent: int) -> DataFrame:
    """Each member of a family against its pivot, from (set_, family_, n_, text).

    Columns set_, family_, n_, linked (with the pivot), plus and minus (members that it
    has beyond the pivot, and the pivot beyond it), change (both). A family's members
    are dealt over tasks, and the pivot alone goes to all of them.
    """
    sizes = stored(
        members.groupBy("family_").agg(
            _blocks(F.count(F.lit(1)), F.sum("n_")).alias("blocks")
        )
    )
    pivot = F.col("set_") == F.col("family_")
    parts = F.when(pivot, F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(
        F.array(F.pmod(F.xxhash64("set_"), F.col("blocks")))
    )
    dealt = (
        members.join(within_bound(sizes, sizes.count()), "family_")
        .withColumn("part", F.explode(parts))
        .select(
            F.xxhash64("family_", "part").alias("unit"), "family_", "part", "set_", "text",
            pivot.alias("pivot"),
        )
        .repartition("unit")
        .sortWithinPartitions("unit", "family_", "part", F.desc("pivot"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for runs in sorted_runs(batches, "unit"):
            first = runs.column("pivot").to_pylist()
            ids, family = runs.column("set_").to_numpy(), runs.column("family_").to_numpy()
            part, texts = runs.column("part").to_numpy(), runs.column("text")
            rows, head = [], None
            for i, is_first in enumerate(first):
                own = shingles(texts[i].as_py())
                if is_first:
                    head = own
                    if part[i]:
                        continue  # told once, in part 0
                change = np.setxor1d(own, head, assume_unique=True)
                n, m = len(own), len(head)
                plus = (len(change) + n - m) // 2
                inter = n - plus
                linked = 100 * inter >= percent * (n + m - inter)
                rows.append(
                    (ids[i], family[i], n, linked, plus, m - inter, _signed(change))
                )
            columns = zip(*rows, strict=True) if rows else [[]] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(columns, _STAR.values(), strict=True)],
                list(_STAR),
            )

    return dealt.mapInArrow(
        run,
        "set_ long, family_ long, n_ long, linked boolean, plus long, minus long, "
        "change array<long>",
    )


_STAR = {name: pa.int64() for name in ("set_", "family_", "n_")}
_STAR |= {"linked": pa.bool_(), "plus": pa.int64(), "minus": pa.int64()}
_STAR |= {"change": pa.list_(pa.int64())}


def rest_edges(held: DataFrame, percent: int) -> DataFrame:
    """Links of members that don't link with their pivot, inside their families.

    They are dealt over blocks, and so are the others; each of their blocks meets all
    the family's blocks. Pairs of two members linked with the pivot need no test.
    """
    tokens = F.size("change")
    sizes = stored(
        held.groupBy("family_")
        .agg(
            F.count(F.lit(1)).alias("members"),
            F.count(F.when(~F.col("linked"), 1)).alias("rest"),
            F.sum(F.when(~F.col("linked"), tokens).otherwise(0)).alias("rest_tokens"),
            F.sum(F.when(F.col("linked"), tokens).otherwise(0)).alias("tokens"),
        )
        # Of two members, one is the pivot: nothing is left to test.
        .filter("rest > 0 AND members > 2")
        .select(
            "family_",
            _blocks(F.col("rest"), F.col("rest_tokens")).alias("open"),
            _blocks(F.col("members") - F.col("rest"), F.col("tokens")).alias("others"),
        )
    )
    own = F.when(
        F.col("linked"), F.col("open") + F.pmod(F.xxhash64("set_"), F.col("others"))
    ).otherwise(F.pmod(F.xxhash64("set_"), F.col("open")))
    last = F.when(F.col("linked"), F.col("open")).otherwise(F.col("open") + F.col("others"))
    blocks = F.col("open") + F.col("others")
    met = F.filter(F.sequence(F.lit(0), last - 1), lambda j: j != F.col("own"))
    dealt = (
        held.join(within_bound(sizes, sizes.count()), "family_")
        .withColumn("own", own)
        .withColumn("met", F.explode(met))
        .withColumn("unit", F.least("own", "met") * blocks + F.greatest("own", "met"))
        .select(F.xxhash64("family_", "unit").alias("unit"), "family_", "set_", "n_", "change")
        .repartition("unit")
        .sortWithinPartitions("unit", "family_")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for runs in sorted_runs(batches, "unit"):
            unit, family = (runs.column(c).to_numpy() for c in ("unit", "family_"))
            ids, sizes = runs.column("set_").to_numpy(), runs.column("n_").to_numpy()
            changes = runs.column("change").combine_chunks()
            cuts = np.flatnonzero((np.diff(unit) != 0) | (np.diff(family) != 0)) + 1
            edges = []
            for lo, hi in zip([0, *cuts], [*cuts, len(unit)], strict=True):
                if hi - lo > 1:
                    own = [changes[i].values.to_numpy() for i in range(lo, hi)]
                    edges += forest(ids[lo:hi], sizes[lo:hi], own, percent)
            yield _pairs(edges)

    return dealt.mapInArrow(run, "a long, b long")


def _pairs(edges, names: tuple[str, ...] = ("a", "b")) -> pa.RecordBatch:
    flat = np.array(edges, "int64").reshape(-1, len(names))
    return pa.RecordBatch.from_arrays([pa.array(c) for c in flat.T.copy()], list(names))


# --- the index across families -----------------------------------------------------


def prefixes(rows: DataFrame, text_col: str, counts: np.ndarray, percent: int) -> DataFrame:
    """(set_, tokens): each set's rarest tokens, rarest first."""
    # Only the order counts; above the greatest number all are alike.
    small = np.minimum(counts, np.iinfo("uint32").max).astype("uint32")
    shipped = rows.sparkSession.sparkContext.broadcast(small)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = shipped.value
        for whole in batches:
            for start in range(0, whole.num_rows, 1024):
                batch = whole.slice(start, 1024)
                tokens = []
                for text in batch.column(1):
                    own = shingles(text.as_py())
                    n = len(own)
                    often = counters[(own % np.uint64(SKETCH)).astype("int64")]
                    length = min(n, n - least_partner(n, percent) + SHARED)
                    first = np.lexsort((own, often))[:length]
                    tokens.append(_signed(own[first]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(tokens, pa.list_(pa.int64()))],
                    ["set_", "tokens"],
                )

    return rows.select(F.col("row_").alias("set_"), text_col).mapInArrow(
        run, "set_ long, tokens array<long>"
    )


def with_parts(postings: DataFrame, total: int) -> DataFrame:
    """``postings``, of at most ``total`` rows, with ``parts``: over how many tasks the
    list of their ``token`` is dealt, by the number of its entries."""
    lengths = stored(
        postings.groupBy("token")
        .agg(F.count(F.lit(1)).alias("entries"))
        .filter(F.col("entries") > LIST)
    )
    if total <= LIST * MAX_HOT_KEYS:
        # So there are at most MAX_HOT_KEYS such tokens.
        found = postings.join(F.broadcast(lengths), "token", "left")
    else:
        found = join_dealt(postings, lengths, "token", total, "entries", how="left")
    parts = F.ceil(F.coalesce("entries", F.lit(1)) / F.lit(LIST)).cast("int")
    return found.withColumn("parts", parts).drop("entries")


def list_pairs(
    sets: np.ndarray, family: np.ndarray, size: np.ndarray, place: np.ndarray,
    chunk: np.ndarray, percent: int,
) -> Iterator[np.ndarray]:
    """Pairs of one list that pass the tests on size, position and family."""
    order = np.lexsort((size, place))
    sets, family, size, place, chunk = (
        x[order] for x in (sets, family, size, place, chunk)
    )
    # Blocks hold one position each, in order of size, and at most BLOCK entries.
    starts = np.flatnonzero(np.diff(place, prepend=-1))
    ends = np.append(starts[1:], len(place))
    blocks = [
        (lo, min(lo + BLOCK, hi))
        for first, hi in zip(starts, ends, strict=True)
        for lo in range(first, hi, BLOCK)
    ] if len(place) > 64 else [(0, len(place))]
    for i, (lo, hi) in enumerate(blocks):
        for lo2, hi2 in blocks[i:]:
            a, b = slice(lo, hi), slice(lo2, hi2)
            least_a, least_b = size[a].min(), size[b].min()
            # Shared tokens before this one, and from it on, at most.
            room = min(place[a].max(), place[b].max())
            room += min((size[a] - place[a]).max(), (size[b] - place[b]).max())
            if room < overlap_needed(least_a, least_b, percent):
                continue
            if least_partner(least_a, percent) > size[b].max():
                continue
            if least_partner(least_b, percent) > size[a].max():
                continue
            small = np.minimum(size[a][:, None], size[b][None, :])
            large = np.maximum(size[a][:, None], size[b][None, :])
            good = (
                (small >= least_partner(large, percent))
                & (family[a][:, None] != family[b][None, :])
                & (sets[a][:, None] != sets[b][None, :])
            )
            if lo == lo2:
                good &= np.tri(hi - lo, k=-1, dtype=bool)
            if (chunk != chunk[0]).any():  # one chunk against another
                good &= chunk[a][:, None] != chunk[b][None, :]
            x, y = np.nonzero(good)
            if len(x):
                x, y = x + lo, y + lo2
                x, y = np.where(sets[x] < sets[y], x, y), np.where(sets[x] < sets[y], y, x)
                yield np.column_stack([sets[x], sets[y], size[x], size[y]])


def short_list_pairs(
    starts: np.ndarray, ends: np.ndarray, columns: list[np.ndarray], percent: int
) -> np.ndarray:
    """The pairs of many short lists at once, by the tests of ``list_pairs`` on each pair.

    Lists are ranges of ``columns`` (set_, family, size, place, chunk).
    """
    sets, family, size, place, chunk = columns
    # One chunk against another: pairs inside a chunk are tested in its own list.
    mixed = np.minimum.reduceat(chunk, starts) != np.maximum.reduceat(chunk, starts)
    wanted = ends - starts <= SHORT
    starts, ends, mixed = starts[wanted], ends[wanted], mixed[wanted]
    found = [np.empty((0, 4), "int64")]
    lengths = ends - starts
    owner = np.repeat(np.arange(len(starts)), lengths)
    rows = np.arange(len(owner)) - np.repeat(np.cumsum(lengths) - lengths, lengths) + starts[owner]
    for step in range(1, int(lengths.max(initial=0))):
        inside = rows + step < ends[owner]
        rows, owner = rows[inside], owner[inside]
        x, y = rows, rows + step
        room = np.minimum(place[x], place[y])
        room = room + np.minimum(size[x] - place[x], size[y] - place[y])
        good = (
            (np.minimum(size[x], size[y]) >= least_partner(np.maximum(size[x], size[y]), percent))
            & (room >= overlap_needed(size[x], size[y], percent))
            & (family[x] != family[y])
            & (sets[x] != sets[y])
            & (~mixed[owner] | (chunk[x] != chunk[y]))
        )
        x, y = x[good], y[good]
        x, y = np.where(sets[x] < sets[y], x, y), np.where(sets[x] < sets[y], y, x)
        found.append(np.column_stack([sets[x], sets[y], size[x], size[y]]))
    return np.concatenate(found)


def candidates(
    rows: DataFrame, text_col: str, classes: DataFrame, family: DataFrame,
    counts: np.ndarray, percent: int,
) -> DataFrame:
    """Pairs (a, b) across families that share enough of their prefixes."""
    sets = classes.select("set_", "n_").join(family, "set_", "left").select(
        "set_", F.col("n_").cast("int").alias("n"), F.coalesce("family_", "set_").alias("family")
    )
    held = stored(prefixes(rows, text_col, counts, percent).join(sets, "set_"))
    length = F.expr(f"least(n_, n_ - ({percent} * n_ + 99) div 100 + {SHARED})")
    total = classes.agg(F.sum(length)).first()[0] or 0
    postings = held.select("set_", "n", "family", F.posexplode("tokens").alias("place", "token"))
    chunk = F.pmod(F.xxhash64("set_"), F.col("parts")).cast("int")
    units = F.when(F.col("parts") == 1, F.array(F.lit(0))).otherwise(
        F.transform(
            F.sequence(F.lit(0), F.col("parts") - 1),
            lambda j: F.least(F.col("chunk"), j) * F.col("parts") + F.greatest(F.col("chunk"), j),
        )
    )
    dealt = (
        with_parts(postings, total)
        .withColumn("chunk", chunk)
        .select("*", F.explode(units).alias("unit"))
        .select(F.xxhash64("token", "unit").alias("list"), "set_", "n", "family", "place", "chunk")
        .repartition("list")
        .sortWithinPartitions("list")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for runs in sorted_runs(batches, "list"):
            columns = [
                runs.column(c).to_numpy() for c in ("set_", "family", "n", "place", "chunk")
            ]
            keys = runs.column("list").to_numpy()
            ends = np.concatenate([[0], np.flatnonzero(np.diff(keys)) + 1, [len(keys)]])
            found = [short_list_pairs(ends[:-1], ends[1:], columns, percent)]
            held = len(found[0])
            for k in np.flatnonzero(np.diff(ends) > SHORT):
                own = [c[ends[k] : ends[k + 1]] for c in columns]
                if (own[1] == own[1][0]).all():
                    continue  # one family: its links are found elsewhere
                for pairs in list_pairs(*own, percent):
                    found.append(pairs)
                    held += len(pairs)
                    if held > 100_000:
                        yield _pairs(np.concatenate(found), ("a", "b", "na", "nb"))
                        found, held = [], 0
            if found:
                yield _pairs(np.concatenate(found), ("a", "b", "na", "nb"))

    shared = (
        dealt.mapInArrow(run, "a long, b long, na long, nb long")
        .groupBy("a", "b", "na", "nb")
        .agg(F.count(F.lit(1)).alias("shared"))
    )
    # |prefix & prefix| >= overlap - the largest number of tokens left out of one.
    return shared.filter(
        F.expr(
            f"shared >= (({percent} * (na + nb) + {99 + percent}) div {100 + percent})"
            f" + least(0, {SHARED} - (({percent} * greatest(na, nb) + 99) div 100))"
        )
    ).select("a", "b", "na", "nb")


def overlaps(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """(a, b, inter, linked) of the pairs (a, b), by their whole sets; ``texts`` has
    (set_, text)."""
    whole = pairs.join(texts.toDF("a", "text_a"), "a").join(texts.toDF("b", "text_b"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shared, linked = [], []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = shingles(x.as_py()), shingles(y.as_py())
                inter = len(np.intersect1d(x, y, assume_unique=True))
                shared.append(inter)
                linked.append(100 * inter >= percent * (len(x) + len(y) - inter))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(shared, pa.int64()), pa.array(linked, pa.bool_())],
                ["a", "b", "inter", "linked"],
            )

    return whole.select("a", "b", "text_a", "text_b").mapInArrow(
        run, "a long, b long, inter long, linked boolean"
    )


def behind_pivots(pairs: DataFrame, held: DataFrame) -> DataFrame:
    """``pairs`` (a, b, na, nb) with the pivots p and q that their sets link with (or the
    sets themselves), and plus and minus of both differences together."""
    near = held.filter("linked").select("set_", "family_", "plus", "minus")
    found = pairs.join(near.toDF("a", "p", "plus_a", "minus_a"), "a", "left").join(
        near.toDF("b", "q", "plus_b", "minus_b"), "b", "left"
    )
    zero = F.lit(0)
    return found.select(
        "a", "b", "na", "nb",
        F.coalesce("p", "a").alias("p"),
        F.coalesce("q", "b").alias("q"),
        (F.coalesce("plus_a", zero) + F.coalesce("plus_b", zero)).alias("plus"),
        (F.coalesce("minus_a", zero) + F.coalesce("minus_b", zero)).alias("minus"),
    )


def from_pivots(tagged: DataFrame, answers: DataFrame, percent: int) -> DataFrame:
    """Pairs whose pivots don't link, with ``linked``: what the pivots' overlap says of
    them, null where it leaves them open.

    A pair's overlap is at most the pivots' with all that its sets have beyond them, and
    at least the pivots' without all that they lack.
    """
    known = answers.select(
        F.col("a").alias("p"), F.col("b").alias("q"), "inter", F.col("linked").alias("joined")
    )
    needed = F.expr(f"({percent} * (na + nb) + {99 + percent}) div {100 + percent}")
    linked = F.when(F.col("inter") + F.col("plus") < needed, False).when(
        F.col("inter") - F.col("minus") >= needed, True
    )
    return (
        tagged.filter("a != p OR b != q")
        .select("a", "b", "na", "nb", "plus", "minus",
                F.least("p", "q").alias("p"), F.greatest("p", "q").alias("q"))
        .join(within_bound(known, known.count()), ["p", "q"])
        .filter("NOT joined")
        .select("a", "b", linked.alias("linked"))
    )


def cross_edges(
    pairs: DataFrame, held: DataFrame, texts: DataFrame, percent: int
) -> DataFrame:
    """Edges (a, b) that connect what the links among ``pairs`` connect."""
    tagged = stored(behind_pivots(pairs, held))
    heads = tagged.select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b"))
    answers = stored(overlaps(heads.distinct(), texts, percent))
    told = stored(from_pivots(tagged, answers, percent))
    open_ = overlaps(told.filter("linked IS NULL").select("a", "b"), texts, percent)
    edges = answers.filter("linked").unionByName(open_.filter("linked")).select("a", "b")
    return edges.union(told.filter("linked").select("a", "b"))


# --- components ----------------------------------------------------------------------


def components(edges: DataFrame) -> DataFrame:
    """(set_, root_) for all nodes of ``edges`` (a, b); root_ is the smallest node.

    Large-star and small-star steps in turn, each a stored table, until they change
    nothing: a few rounds, whatever the size of a component.
    """

    def star(edges: DataFrame, large: bool) -> DataFrame:
        both = edges.select("a", "b")
        if large:
            both = both.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        else:
            both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = both.groupBy("a").agg(F.min("b").alias("m"))
        low = low.select("a", F.least("a", "m").alias("m"))
        joined = both.join(low, "a")
        moved = joined.filter("b > a" if large else "b != m").select(
            F.col("b").alias("a"), F.col("m").alias("b")
        )
        if not large:
            moved = moved.union(low.select("a", F.col("m").alias("b")))
        return stored(moved.filter("a != b").distinct())

    def state(edges: DataFrame):
        return edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()

    edges = stored(edges.filter("a != b").distinct())
    before = None
    while (now := state(edges)) != before:
        before = now
        edges = star(star(edges, True), False)
    roots = edges.select(F.col("a").alias("set_"), F.col("b").alias("root_"))
    return roots.union(edges.select("b", "b").distinct())


def _judged(docs: DataFrame, percent: int, id_col: str, text_col: str):
    """``docs`` as a stored table with row_, n_ and digest_, and their classes
    (digest_, copies_, root_, component_id)."""
    if not 50 <= percent <= 100:
        raise ValueError("percent must be from 50 to 100")
    rows = prepared(docs, text_col)
    counts = sketch(rows)
    rows = rows.filter("row_ IS NOT NULL").drop("buckets_", "counts_")
    classes = stored(
        rows.filter("n_ > 0")
        .groupBy("digest_", "n_")
        .agg(
            F.min("row_").alias("set_"),
            F.min(id_col).alias("least_"),
            F.first("minhashes_").alias("minhashes_"),
            F.count(F.lit(1)).alias("copies_"),
        )
    )
    family = families(classes)
    pairs = stored(candidates(rows, text_col, classes, family, counts, percent))
    wanted = stored(
        family.select("set_")
        .union(pairs.select("a"))
        .union(pairs.select("b"))
        .distinct()
        .join(classes.select("set_", "n_"), "set_")
    )
    texts = stored(
        rows.select(F.col("row_").alias("set_"), F.col(text_col).alias("text")).join(
            within_bound(wanted, wanted.count()), "set_"
        )
    )
    held = stored(stars(texts.join(family, "set_"), percent))
    edges = (
        held.filter("linked AND set_ != family_")
        .select(F.col("set_").alias("a"), F.col("family_").alias("b"))
        .union(rest_edges(held, percent))
        .union(cross_edges(pairs, held, texts.select("set_", "text"), percent))
    )
    found = stored(components(edges))
    joined = classes.join(found, "set_", "left").withColumn(
        "root_", F.coalesce("root_", "set_")
    )
    least = joined.groupBy("root_").agg(F.min("least_").alias("component_id"))
    named = joined.join(least, "root_").select("digest_", "copies_", "root_", "component_id")
    return rows.drop("minhashes_"), stored(named)


def _named(rows: DataFrame, named: DataFrame, id_col: str) -> DataFrame:
    """``rows`` with component_row_ and component_id; frequent texts stay in place."""
    total = named.agg(F.sum("copies_")).first()[0] or 0
    found = join_dealt(rows.filter("n_ > 0"), named, "digest_", total, "copies_")
    empty = rows.filter("n_ = 0").withColumns(
        {"root_": F.col("row_"), "component_id": F.col(id_col)}
    )
    return found.drop("copies_").unionByName(empty).withColumnRenamed("root_", "component_row_")


def near_duplicates(
    docs: DataFrame, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` with row_ (unique), n_shingles, component_id and component_row_.

    component_id is the smallest id reachable by links, the row's own if there are
    none; component_row_ is the same for the rows of one component. Null and empty
    texts have empty sets and link with nothing; null ids are no component_id unless
    a component has no other. Repeated rows link like any equal texts. Further
    columns are kept; names ending in ``_`` are reserved.
    """
    docs = docs.drop("n_shingles", "component_id")
    rows, named = _judged(docs, percent, id_col, text_col)
    return _named(rows, named, id_col).withColumnRenamed("n_", "n_shingles").drop("digest_")


def keep_one(docs: DataFrame, percent: int = PERCENT, text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component: the first by id (null last).

    All columns keep their values, those named like a result of ``near_duplicates`` too.
    Texts without words, null and empty, are components of their own and stay. Names
    ending in ``_`` are reserved. Which rows stay is decided on ids and digests; whole
    rows are shuffled once, to be picked.
    """
    docs, back = set_aside(docs, ["n_shingles", "component_id"])
    rows, named = _judged(docs, percent, "doc_id", text_col)
    place = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("row_"))
    first = (
        _named(rows.select("doc_id", "row_", "n_", "digest_"), named, "doc_id")
        .groupBy("component_row_")
        .agg(F.min(place).alias("first_"))
        .select(F.col("first_.row_").alias("row_"))
    )
    return rows.join(first, "row_", "left_semi").select(*back)


def op5_set_relations(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs).select("doc_id", "n_shingles", "component_id")


OP5_SQL = r"""
WITH RECURSIVE docs AS (
    SELECT row_number() OVER () AS row_no, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
    FROM documents
),
shingle AS (
    SELECT DISTINCT row_no, array_to_string(list_slice(words, s, s + 2), ' ') AS three
    FROM (SELECT row_no, words, unnest(range(1, greatest(len(words) - 2, 1) + 1)) AS s
          FROM docs WHERE len(words) > 0)
),
sizes AS (SELECT row_no, count(*) AS n FROM shingle GROUP BY row_no),
link AS (
    SELECT x.row_no AS a, y.row_no AS b
    FROM shingle x JOIN shingle y USING (three)
         JOIN sizes p ON p.row_no = x.row_no JOIN sizes q ON q.row_no = y.row_no
    WHERE x.row_no <> y.row_no
    GROUP BY x.row_no, y.row_no, p.n, q.n
    HAVING 100 * count(*) >= 90 * (p.n + q.n - count(*))
),
reach AS (
    SELECT row_no AS a, row_no AS b FROM docs
    UNION
    SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b
),
least AS (
    SELECT reach.a AS row_no, min(d.doc_id) AS component_id
    FROM reach JOIN docs d ON d.row_no = reach.b GROUP BY reach.a
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM docs JOIN least USING (row_no) LEFT JOIN sizes USING (row_no)"""
