"""From raw lines to the rows a load adds: parse, judge, deduplicate, compare.

Lines carry ``value`` and their place: ``source_file, block_start, line``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweir.functions.jsonlines import payload_text, strip
from logweir.plans.shared import MAX_BROADCAST_ROWS, within_bound
from logweir.plans.shared import stored_and_counted as written
from logweir.schemas import RAW_EVENT

# Files are taken in name order; a file cut into blocks keeps its line order.
PLACE = ["source_file", "block_start", "line"]


def _timestamp(text: Column) -> Column:
    """Naive timestamp of ISO text; NULL for anything else.

    A date needs its day: a bare year or month would pass the cast.
    """
    return F.when(F.length(text) >= 8, text).try_cast("timestamp_ntz")


def parse_lines(lines: DataFrame) -> DataFrame:
    """Event columns of each line, with ``status`` ok, violating or fatal.

    fatal: not exactly one JSON object, or ``actor``/``repo`` present without
    being an object. violating: a required value is missing or a value does not
    fit its column.
    """
    # Read between brackets and before a second element, so that a line with
    # anything after its object does not pass. Exploding the list keeps later
    # filters from repeating the read.
    listed = F.concat(F.lit("["), F.col("value"), F.lit(",{}]"))
    schema = f"array<{RAW_EVENT.simpleString()}>"
    read = F.from_json(listed, schema, {"allowSingleQuotes": "false"})
    object_alone = F.when(F.size("read") == 2, F.slice("read", 1, 1))
    return (
        lines.withColumn("value", strip(F.col("value")))
        .withColumn("read", read)
        .select(*PLACE, "value", F.explode_outer(object_alone).alias("one"))
        .select(
            *PLACE,
            F.col("one.id").alias("event_id"),
            F.col("one.type").alias("event_type"),
            _timestamp(F.col("one.created_at")).alias("created_at"),
            _timestamp(F.col("one._ingested_at")).alias("ingested_at"),
            F.col("one.actor.id").try_cast("int").alias("actor_id"),
            F.col("one.actor.login").alias("actor_login"),
            F.col("one.repo.id").try_cast("int").alias("repo_id"),
            F.col("one.repo.name").alias("repo_name"),
            payload_text(F.col("one.payload"), F.col("value")).alias("payload"),
            F.col("value").alias("raw"),
            "one",
        )
        .withColumn("status", _status())
        .drop("one")
    )


def _status() -> Column:
    # The keys are listed only where something is missing; as a branch of a CASE
    # they are not computed ahead for every line.
    no_actor, no_repo = F.col("one.actor").isNull(), F.col("one.repo").isNull()
    keys = F.json_object_keys("raw")
    no_object = F.when(
        no_actor | no_repo,
        (no_actor & F.array_contains(keys, "actor"))
        | (no_repo & F.array_contains(keys, "repo")),
    )

    def unfit(text: str, number: str) -> Column:
        return F.col(text).isNotNull() & F.col(number).isNull()

    fatal = (
        ~F.is_valid_utf8("raw")
        | F.col("one").isNull()
        | F.coalesce(no_object, F.lit(False))
    )
    violating = (
        F.col("event_id").isNull()
        | F.col("event_type").isNull()
        | F.col("created_at").isNull()
        | F.col("ingested_at").isNull()
        | unfit("one.actor.id", "actor_id")
        | unfit("one.repo.id", "repo_id")
    )
    return F.when(fatal, "fatal").when(violating, "violating").otherwise("ok")


def id_table(parsed: DataFrame) -> DataFrame:
    """One row per event id and file: all that deciding about lines takes.

    ``lost`` says that a line fails the file whatever else is there, ``good`` and
    ``bad`` are the places of the first ok and the first violating line, ``copies`` is
    the number of ok lines.
    """
    ok, place = F.col("status") == "ok", F.struct(*PLACE[1:])
    return parsed.groupBy("event_id", "source_file").agg(
        F.max((F.col("status") == "fatal") | (F.col("event_id").isNull() & ~ok)).alias("lost"),
        F.min(F.when(ok, place)).alias("good"),
        F.min(F.when(F.col("status") == "violating", place)).alias("bad"),
        F.count_if(ok).alias("copies"),
    )


def failed_files(parsed: DataFrame, stored: DataFrame) -> DataFrame:
    """Names of the files that must contribute nothing.

    A fatal line fails its file. So does a violating one, unless its event is
    there already: stored by an earlier load, or read from an ok line further
    up in this file or in an earlier file that does not fail itself. The last
    clause is why the answer is found in rounds; failures only ever grow, and
    nearly always the first round settles it.
    """
    return failures(written(id_table(parsed))[0], stored)


def failures(ids: DataFrame, stored: DataFrame) -> DataFrame:
    """``failed_files`` from a written ``id_table``; only its narrow rows are read.

    A round looks at those doubtful lines alone that leant on a file which failed in
    the round before.
    """
    failed = ids.filter("lost").select("source_file").distinct()
    doubts = ids.filter("bad IS NOT NULL AND NOT lost AND (good IS NULL OR bad < good)")
    doubts, count = written(
        doubts.select("event_id", "source_file").join(
            stored.select("event_id"), "event_id", "left_anti"
        )
    )
    if not count:
        return failed
    support = ids.filter("good IS NOT NULL").select("event_id", "source_file")
    support, _ = written(
        support.join(within_bound(doubts.select("event_id"), count), "event_id", "left_semi")
    )
    failed, known = written(failed)
    open_ = doubts
    while True:
        earliest = (
            without_files(support, failed, known)
            .groupBy("event_id")
            .agg(F.min("source_file").alias("earliest"))
        )
        unmet = open_.join(earliest, "event_id", "left").filter(
            F.col("earliest").isNull() | (F.col("earliest") >= F.col("source_file"))
        )
        new = without_files(unmet.select("source_file").distinct(), failed, known)
        new, more = written(new)
        if not more:
            return failed
        failed, known = failed.union(new), known + more
        fallen = support.join(within_bound(new, more), "source_file", "left_semi")
        open_ = doubts.join(fallen.select("event_id").distinct(), "event_id", "left_semi")


def without_files(rows: DataFrame, failed: DataFrame, failures: int) -> DataFrame:
    return rows.join(within_bound(failed, failures), "source_file", "left_anti")


def dedup_first(parsed: DataFrame) -> DataFrame:
    """The first line of each event id, by file name and place in the file.

    The first place is a minimum over narrow rows, which shrink before the shuffle.
    Whole lines are only looked up by id and place, so that an id repeated any number
    of times never gathers in one task. A place must belong to one line for good, as
    in a written table.
    """
    first = parsed.groupBy("event_id").agg(F.min(F.struct(*PLACE)).alias("first_"))
    first = first.select(F.col("event_id").alias("id_"), "first_.*").toDF(
        "id_", *(f"{name}_" for name in PLACE)
    )
    same = F.col("event_id").eqNullSafe(F.col("id_"))
    for name in PLACE:
        same &= F.col(name) == F.col(f"{name}_")
    return parsed.join(first, same, "left_semi")


def drop_existing(
    new: DataFrame, stored: DataFrame, new_rows: int | None = None
) -> DataFrame:
    """Rows of ``new`` whose event is not in ``stored``; both unique by id.

    When ``new`` is known to be small, its ids go to the stored side first and
    only the hits come back, so the big table is scanned but not shuffled.
    """
    ids = stored.select("event_id")
    if new_rows is None or new_rows > MAX_BROADCAST_ROWS:
        return new.join(ids, "event_id", "left_anti")
    hits = ids.join(F.broadcast(new.select("event_id")), "event_id", "left_semi")
    return new.join(F.broadcast(hits), "event_id", "left_anti")


def classify_files(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """``status`` new, unchanged or modified, by name and SHA-256.

    No broadcast hint: the manifest grows with every load, so the choice is
    left to Spark, which looks at its size.
    """
    known = manifest.select("file_path", F.col("file_sha256").alias("known_sha256"))
    status = (
        F.when(F.col("known_sha256").isNull(), "new")
        .when(F.col("known_sha256") == F.col("file_sha256"), "unchanged")
        .otherwise("modified")
    )
    return files.join(known, "file_path", "left").withColumn("status", status)


def latest_by(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The row with the greatest ``order`` per key: appends read as upserts."""
    rest = [name for name in rows.columns if name not in (key, order)]
    latest = F.max(F.struct(order, *rest)).alias("latest")
    return rows.groupBy(key).agg(latest).select(key, "latest.*")
