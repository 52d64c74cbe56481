"""Mixing sources to target weights by pivotal dependent rounding.

A document of source s should appear ``target_s / size_s`` times. The whole part
is certain; the fraction is rounded so that every document is right on average
and the words of a source hardly move. A fractional document is paired with the
rest of its group: words pass from one side to the other, in a random direction
with the odds that leave all means as they were, until the document is whole (or
the rest is). The rest moves as one, by the same affine map of all its fractions,
so that even a very long document finds enough words on the other side; the
largest goes first and what stays fractional is small.

Groups form a reduction tree: hashed groups of about 64 documents of a source
leave one fractional document each, which meet in the next level, until one is
left in a source. Only that one is rounded alone, so a source misses its
target by less than one (small) document. A level is one shuffle of narrow rows;
the largest source only has more groups than others.

All random numbers are hashes of ids, texts and the seed, so reruns agree.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logweir.llm.common import stored, table, uniform, within_bound, word_count

GROUP = 64

_ITEM = "struct<mass:double,h:bigint,frac:double,source_no:int,key:struct<doc_id:{id},text_hash:bigint>>"

# The state of a group: the rest of its items has fractions a * frac + b, the mass m
# and the (original) fractional mass g; cur is the one item left fractional.
_STATE = "struct<a:double,b:double,m:double,g:double,cur:{item},done:array<{item}>>"

# x against the rest: words go from the rest to x (up) or back (down).
_STEP = """transform(array(named_struct(
    's', s, 'x', x, 'm', s.m - x.mass, 'g', s.g - x.mass * x.frac,
    'f', CASE WHEN s.a * x.frac + s.b < 1e-12 THEN 0D
              WHEN s.a * x.frac + s.b > 1 - 1e-12 THEN 1D
              ELSE s.a * x.frac + s.b END)), t -> transform(array(named_struct(
    't', t, 'have', greatest(0D, s.a * t.g + s.b * t.m),
    'room', greatest(0D, t.m - s.a * t.g - s.b * t.m))), p -> transform(array(
    named_struct('p', p, 'down', least(x.mass * t.f, p.room),
                 'up', least(x.mass * (1 - t.f), p.have))), q -> CASE
    WHEN t.f = 0 OR t.f = 1 THEN {whole}
    WHEN s.cur IS NULL AND (q.up + q.down = 0 OR t.m < 0.5) THEN {last}
    WHEN {uniform} * (q.down + q.up) < q.down THEN
        CASE WHEN x.mass * (1 - t.f) <= p.have THEN {up} ELSE {up_part} END
    ELSE CASE WHEN x.mass * t.f <= p.room THEN {down} ELSE {down_part} END
    END)[0])[0])[0]"""


def _next(item_type: str, a: str, b: str, frac: str, whole: bool) -> str:
    item = (
        f"CAST(named_struct('mass', x.mass, 'h', x.h, 'frac', {frac}, "
        f"'source_no', x.source_no, 'key', x.key) AS {item_type})"
    )
    cur = "s.cur" if whole else item
    done = f"array_append(s.done, {item})" if whole else "s.done"
    return (
        f"CAST(named_struct('a', {a}, 'b', {b}, 'm', t.m, 'g', t.g, 'cur', {cur}, "
        f"'done', {done}) AS {_STATE.format(item=item_type)})"
    )


def _reduce_group(items: str, item_type: str, level: int, seed: int) -> Column:
    """Make the items of a group whole, the largest first, all but one."""
    up, down = "(1 - q.up / p.have)", "(1 - q.down / p.room)"
    step = _STEP.format(
        uniform=f"(shiftrightunsigned(xxhash64(x.h, {level}, {seed}), 11)"
        " / 9007199254740992D)",
        whole=_next(item_type, "s.a", "s.b", "t.f", True),
        last=_next(item_type, "s.a", "s.b", "t.f", False),
        up=_next(item_type, f"s.a * {up}", f"s.b * {up}", "1D", True),
        up_part=_next(item_type, "0D", "0D", "t.f + p.have / x.mass", False),
        down=_next(item_type, f"s.a * {down}", f"s.b * {down} + (1 - {down})", "0D", True),
        down_part=_next(item_type, "0D", "1D", "t.f - p.room / x.mass", False),
    )
    start = (
        "CAST(named_struct('a', 1D, 'b', 0D, "
        f"'m', aggregate({items}, 0D, (n, x) -> n + x.mass), "
        f"'g', aggregate({items}, 0D, (n, x) -> n + x.mass * x.frac), "
        f"'cur', NULL, 'done', array()) AS {_STATE.format(item=item_type)})"
    )
    return F.expr(f"aggregate(sort_array({items}, false), {start}, (s, x) -> {step})")


def source_targets(
    sizes: DataFrame, weights: Sequence[float], share: float, most: float
) -> DataFrame:
    """Add ``source_no`` and ``target`` to (source, source_size, ...).

    ``weights`` go to the sources in code point order, null last, and repeat.
    Together the targets are ``share`` of all words; one that would exceed
    ``most`` times its source stops there and the others take its excess by
    weight. With sources in the order of size by weight, the common level of the
    rest is the largest of (words left) / (weight left). One row per source, so
    the windows over all of them are small.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    fill = Window.orderBy("ratio_", "source_no")
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    after = fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    values = F.array(*[F.lit(float(w)) for w in weights])
    return (
        sizes.withColumn("source_no", F.row_number().over(order))
        .withColumn(
            "weight_",
            F.element_at(values, F.pmod(F.col("source_no") - 1, F.lit(len(weights))) + 1),
        )
        .withColumn("cap_", F.col("source_size") * F.lit(float(most)))
        .withColumn("ratio_", F.col("cap_") / F.col("weight_"))
        .withColumn("all_", F.sum("source_size").over(everything) * F.lit(float(share)))
        .withColumn(
            "level_",
            (F.col("all_") - F.coalesce(F.sum("cap_").over(before), F.lit(0.0)))
            / F.sum("weight_").over(after),
        )
        .withColumn("level_", F.max("level_").over(everything))
        .withColumn("target", F.least("cap_", F.col("level_") * F.col("weight_")))
        .drop("weight_", "cap_", "ratio_", "all_", "level_")
    )


def plan_copies(
    docs: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    seed: int = 0,
) -> DataFrame:
    """One row per distinct (doc_id, source, text) of ``docs``.

    Columns: doc_id, source, text_hash, rows (how many such rows there are), size
    (words), source_size, target, copies (of each of these rows). Rows that are
    repeated whole share one decision. Null ids, sources and texts are values of
    their own. Documents without words carry no weight and get one copy. Further
    columns are not looked at; an empty table gives an empty plan.
    """
    units = stored(
        docs.select(
            "doc_id",
            "source",
            F.xxhash64("text").alias("text_hash"),
            word_count(F.col("text")).alias("size"),
        )
        .groupBy("doc_id", "source", "text_hash", "size")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    sizes = units.groupBy("source").agg(
        F.sum(F.col("size") * F.col("rows")).alias("source_size"),
        F.count(F.lit(1)).alias("units_"),
    )
    sources = stored(source_targets(sizes, weights, share, most))
    sources = within_bound(sources, sources.count())
    wanted = F.when(
        F.col("source_size") > 0, F.col("target") / F.col("source_size")
    ).otherwise(F.lit(1.0))
    # A target at the cap may come out a rounding error beside a whole number.
    near = F.round(F.col("wanted_"))
    whole = F.when(F.abs(F.col("wanted_") - near) < 1e-12, near).otherwise(
        F.floor("wanted_").cast("double")
    )
    planned = (
        units.alias("u")
        .join(sources.alias("s"), F.expr("u.source <=> s.source"))
        .select("u.*", "s.source_size", "s.source_no", "s.target", "s.units_")
        .withColumn("wanted_", wanted)
        .withColumn("base_", whole)
        .withColumn("frac_", F.greatest(F.lit(0.0), F.col("wanted_") - F.col("base_")))
    )
    id_type = docs.schema["doc_id"].dataType.simpleString()
    item_type = _ITEM.format(id=id_type)
    item = F.struct(
        (F.col("size") * F.col("rows")).cast("double").alias("mass"),
        F.xxhash64("doc_id", "text_hash", "source", F.lit(seed)).alias("h"),
        F.col("frac_").alias("frac"),
        F.col("source_no").cast("int").alias("source_no"),
        F.struct("doc_id", "text_hash").alias("key"),
    ).cast(item_type)
    open_ = (F.col("frac_") > 0) & (F.col("size") > 0)
    level, decided = 0, []
    items = planned.filter(open_).select(item.alias("x"), F.col("units_").alias("n"))
    while True:
        groups = F.ceil(F.col("n") / F.lit(GROUP)).cast("long")
        state = stored(
            items.groupBy(
                F.col("x.source_no").alias("no"),
                F.pmod(F.xxhash64("x.h", F.lit(level)), groups).alias("group"),
            )
            .agg(F.collect_list("x").alias("xs"))
            .select("no", _reduce_group("xs", item_type, level, seed).alias("state"))
        )
        decided.append(state.select(F.explode("state.done").alias("x")))
        left = state.filter(F.col("state.cur").isNotNull()).groupBy("no").agg(F.count(F.lit(1)).alias("n"))
        most_left = left.agg(F.max("n")).first()[0] or 0
        if most_left <= 1:
            break
        # A few rows per source: joined to the residuals of the same source.
        carried = state.filter(F.col("state.cur").isNotNull())
        items = carried.join(within_bound(left, left.count()), "no").select(
            F.col("state.cur").alias("x"), "n"
        )
        level += 1
    last = F.col("state.cur")
    alone = uniform(F.col("state.cur.h"), F.lit(seed), F.lit(-1)) < F.col("state.cur.frac")
    decided.append(
        state.filter(last.isNotNull()).select(
            F.struct(
                last["mass"].alias("mass"),
                last["h"].alias("h"),
                F.when(alone, F.lit(1.0)).otherwise(F.lit(0.0)).alias("frac"),
                last["source_no"].alias("source_no"),
                last["key"].alias("key"),
            )
            .cast(item_type)
            .alias("x")
        )
    )
    rounded = reduce(DataFrame.unionByName, decided).select(
        F.col("x.key.doc_id").alias("doc_id_"),
        F.col("x.key.text_hash").alias("text_hash_"),
        F.col("x.source_no").alias("source_no_"),
        F.col("x.frac").alias("up_"),
    )
    same = F.expr(
        "doc_id <=> doc_id_ AND text_hash = text_hash_ AND source_no = source_no_"
    )
    copies = F.when(F.col("size") == 0, F.lit(1)).otherwise(
        F.col("base_") + F.coalesce("up_", F.lit(0.0))
    )
    return planned.join(rounded, same, "left").select(
        "doc_id",
        "source",
        "text_hash",
        "rows",
        "size",
        "source_size",
        "target",
        copies.cast("int").alias("copies"),
    )


def mix(docs: DataFrame, **how) -> DataFrame:
    """The mixed documents: every row as often as its plan says, maybe not at all.

    Takes the options of ``plan_copies``; returns the columns of ``docs``.
    """
    plan = plan_copies(docs, **how).select(
        F.col("doc_id").alias("doc_id_"),
        F.col("source").alias("source_"),
        F.col("text_hash").alias("text_hash_"),
        F.col("copies").alias("copies_"),
    )
    same = F.expr(
        "doc_id <=> doc_id_ AND source <=> source_ AND xxhash64(text) = text_hash_"
    )
    return (
        docs.join(plan.filter("copies_ > 0"), same)
        .withColumn("copy_", F.explode(F.sequence(F.lit(1), F.col("copies_"))))
        .select(*[F.col(f"`{c}`") for c in docs.columns])
    )


def op1_pivotal_mix(spark, sf_dir: str) -> DataFrame:
    plan = plan_copies(table(spark, sf_dir, "documents"))
    return plan.withColumn("row_", F.explode(F.sequence(F.lit(1), F.col("rows")))).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("copies")).cast("long").alias("taken"),
    )
