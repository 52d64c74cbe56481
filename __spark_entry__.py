"""
the SQL that must give the same rows.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from logweir.functions.jsonlines import add_ingested_at  # noqa: E402
from logweir.functions.time import naive_utc, ntz  # noqa: E402
from logweir.operators import explore, loading, nested, repos, sessions  # noqa: E402
from logweir.plans.shared import run_folder  # noqa: E402
from logweir.sources import id_index  # noqa: E402
from logweir.sources.lake import compact_events, read_events  # noqa: E402
from logweir.sources.landing import land_events  # noqa: E402
from logweir.sources.loader import load_events  # noqa: E402
from logweir.sources.sample_tables import (  # noqa: E402
    SCHEMA,
    adapt,
    canonical_events,
    iso,
    raw_feed,
    sample_table,
)
from logweir.streaming import (  # noqa: E402
    stream_load,
    stream_sessions,
    write_numbered_sessions,
)

AS_OF = "2024-01-31T00:00:00"
PUSH = "purchase"
STAMP = "2024-02-01T00:00:00"

Query = Callable[[SparkSession, str], DataFrame]


def entry(spark: SparkSession) -> DataFrame:
    events = canonical_events(spark, "/root/testdata/sf0.001")
    return sessions.user_sessions(events, days=7, limit=50, as_of=AS_OF)


def _on_events(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(canonical_events(spark, sf_dir))


def _ranked(days: int) -> Query:
    return _on_events(
        lambda events: repos.top_repos(
            events, days=days, limit=10, as_of=AS_OF, push_type=PUSH
        ).drop("processed_at")
    )


def _steps(*columns: str) -> Query:
    def build(events: DataFrame) -> DataFrame:
        scan = sessions.session_scan(
            events.select("event_id", "actor_login", "created_at"),
            days=30,
            as_of=AS_OF,
        )
        return sessions.sessionize(scan).select("event_id", *columns)

    return _on_events(build)


def _flat(version: int) -> Query:
    return _on_events(
        lambda events: nested.flatten_parts(
            nested.repo_events_nested_parts(events, version)
        )
    )


# --- raw lines made from the events table --------------------------------------

def _daily_file() -> Column:
    day = F.col("ts").cast("date").cast("string")
    return F.concat(F.lit("events_"), day, F.lit(".jsonl"))


def _user_day_file() -> Column:
    day = F.col("ts").cast("date").cast("string")
    return F.concat(
        F.lit("events_"), day, F.lit("_user_"), "user_id", F.lit(".jsonl")
    )


def _hourly_file() -> Column:
    """The same hour of every day, sorting among the daily files."""
    hour = F.substring(F.col("ts").cast("string"), 12, 2)
    return F.concat(F.lit("events_2024-01-"), hour, F.lit("_again.jsonl"))


def _clean_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_feed(spark, sf_dir, source_file=_daily_file())


def _twice_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events delivered twice, in files cut by day and by hour."""
    again = raw_feed(spark, sf_dir, source_file=_hourly_file())
    return _clean_feed(spark, sf_dir).union(again)


def _faulty_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file per user and day; events of high value came in damaged."""
    high = F.col("value") > 200
    kind = F.col("event_type")
    return raw_feed(
        spark,
        sf_dir,
        source_file=_user_day_file(),
        # An id beyond 32 bits is violating, a broken number is fatal.
        actor_id=F.when(high & (kind == "signup"), F.lit("3000000000"))
        .when(high & (kind == "error"), F.lit("12x"))
        .otherwise(F.col("user_id").cast("string")),
        created_at=F.when(high & (kind == "view"), "null").otherwise(
            F.concat(F.lit('"'), iso(F.col("ts")), F.lit('"'))
        ),
    )


def _load_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loading.parse_lines(_clean_feed(spark, sf_dir)).drop(
        "block_start", "line", "status"
    )


def _load_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    payload = (
        F.when(kind == "click", "{}")
        .when(kind == "view", " [ ] ")
        .when(kind == "error", "false")
        .when(kind == "signup", '"0"')
        .otherwise(F.col("props"))
    )
    feed = raw_feed(spark, sf_dir, source_file=_daily_file(), payload=payload)
    return loading.parse_lines(feed).select("event_id", "payload")


def _load_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = loading.parse_lines(_faulty_feed(spark, sf_dir))
    return parsed.select("source_file", "line", "status")


def _load_file_atomic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Survivors when everything before the 16th was stored by earlier loads."""
    parsed = loading.parse_lines(_faulty_feed(spark, sf_dir))
    stored = _stored(spark, sf_dir)
    failed = loading.failed_files(parsed, stored)
    good = parsed.filter(F.col("status") == "ok")
    return loading.without_files(good, failed, failed.count()).select(
        "event_id", "source_file"
    )


def _stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = canonical_events(spark, sf_dir)
    return events.filter(F.col("created_at") < ntz("2024-01-16"))


def _load_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = loading.parse_lines(_twice_feed(spark, sf_dir))
    return loading.dedup_first(parsed).select("event_id", "source_file", "created_at")


def _load_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    new = loading.dedup_first(loading.parse_lines(_twice_feed(spark, sf_dir)))
    return loading.drop_existing(new, _stored(spark, sf_dir)).select(
        "event_id", "created_at"
    )


def _land_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = raw_feed(spark, sf_dir, source_file=_daily_file(), stamped=False)
    return feed.select(
        F.col("line").alias("event_id"),
        add_ingested_at(F.col("value"), STAMP).alias("value"),
    )


def _file_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file per user and day, with a fingerprint of the events in it."""
    events = sample_table(spark, sf_dir)
    return events.groupBy(
        _user_day_file().alias("file_path"), F.col("ts").cast("date").alias("day")
    ).agg(
        F.sha2(F.sum("event_id").cast("string"), 256).alias("file_sha256"),
        F.sha2(
            F.sum(F.when(F.col("event_type") != "error", F.col("event_id"))).cast(
                "string"
            ),
            256,
        ).alias("sha256_without_errors"),
    )


def _classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files against a manifest written on the 15th, before errors were added."""
    files = _file_versions(spark, sf_dir)
    manifest = files.filter(
        (F.col("day") <= "2024-01-15") & F.col("sha256_without_errors").isNotNull()
    ).select("file_path", F.col("sha256_without_errors").alias("file_sha256"))
    return loading.classify_files(files.select("file_path", "file_sha256"), manifest)


def _manifest_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classified(spark, sf_dir).select("file_path", "status")


def _load_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What two loads of the same folder report; files are compared, not counted,
    since Spark decides how many a landing writes."""
    folder = _fresh_folder(spark)
    feed = raw_feed(spark, sf_dir, source_file=_daily_file(), stamped=False)
    land_events(feed.select("value"), f"{folder}/raw", max_records=5000, ingest_ts=STAMP)
    rows = []
    for run in (1, 2):
        got = load_events(spark, f"{folder}/raw", f"{folder}/lake", views=False)
        rows.append(
            (
                run,
                got.loaded_files == got.scanned_files,
                got.skipped_files == got.scanned_files,
                got.loaded_files + got.skipped_files == got.scanned_files,
                got.inserted_events,
            )
        )
    return spark.createDataFrame(
        rows,
        "run int, all_loaded boolean, all_skipped boolean, all_counted boolean, "
        "inserted_events long",
    )


def _manifest_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event as a new version of its user's file; the last one counts."""
    versions = sample_table(spark, sf_dir).select(
        F.concat(F.lit("user_"), "user_id", F.lit(".jsonl")).alias("file_path"),
        F.col("ts").alias("loaded_at"),
        F.sha2("props", 256).alias("file_sha256"),
    )
    return loading.latest_by(versions, "file_path", "loaded_at")


def _fresh_folder(spark: SparkSession) -> str:
    return run_folder(spark)


def _stored_columns(events: DataFrame) -> DataFrame:
    return events.select(
        "event_id",
        "event_type",
        "created_at",
        "ingested_at",
        "actor_id",
        "actor_login",
        "repo_id",
        "repo_name",
        "payload",
        "raw",
    )


def _load_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land all events twice, load twice, read the table."""
    folder = _fresh_folder(spark)
    feed = raw_feed(spark, sf_dir, source_file=_daily_file(), stamped=False)
    for size in (150, 5000):
        land_events(
            feed.select("value"), f"{folder}/raw", max_records=size, ingest_ts=STAMP
        )
    for _ in range(2):
        load_events(spark, f"{folder}/raw", f"{folder}/lake", views=False)
    return _stored_columns(read_events(spark, f"{folder}/lake"))


def _load_odd_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folders named with the signs of patterns; what a pattern would match as well
    lies beside them and must stay unread."""
    folder = _fresh_folder(spark)
    feed = raw_feed(spark, sf_dir, source_file=_daily_file(), stamped=False)
    for name, rest in [("q?[1] {a,b}", 0), ("qa1 a", 1)]:
        rows = feed.filter(F.col("line") % 2 == rest).select("value")
        land_events(rows, f"{folder}/{name}", max_records=5000, ingest_ts=STAMP)
    for _ in range(2):
        load_events(spark, f"{folder}/q?[1] {{a,b}}", f"{folder}/lake[1]*", views=False)
    return _stored_columns(read_events(spark, f"{folder}/lake[1]*"))


def _load_compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three loads of three slices, made one batch; rows and batches afterwards."""
    folder = _fresh_folder(spark)
    feed = raw_feed(spark, sf_dir, source_file=_daily_file(), stamped=False)
    for part in range(3):
        land_events(
            feed.filter(F.col("line") % 3 == part).select("value"),
            f"{folder}/raw",
            max_records=5000,
            ingest_ts=STAMP,
        )
        load_events(spark, f"{folder}/raw", f"{folder}/lake", views=False)
    replaced = compact_events(spark, f"{folder}/lake")
    table = read_events(spark, f"{folder}/lake")
    batches = table.select("batch_id").distinct().count()
    return _stored_columns(table).select(
        "*", F.lit(replaced).alias("replaced"), F.lit(batches).alias("batches")
    )


def _load_id_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New events against a bucketed index of those stored, half of them not covered yet."""
    folder = _fresh_folder(spark)
    stored = raw_feed(spark, sf_dir, source_file=_daily_file(), stamped=False)
    early = F.col("source_file") < "events_2024-01-16"
    for part in (0, 1):
        rows = stored.filter(early & (F.col("line") % 2 == part)).select("value")
        land_events(rows, f"{folder}/raw", max_records=50_000, ingest_ts=STAMP)
        load_events(spark, f"{folder}/raw", f"{folder}/lake", views=False)
        if part == 0:
            id_index.rebuild(spark, f"{folder}/lake", naive_utc(STAMP))
    new = loading.dedup_first(loading.parse_lines(_twice_feed(spark, sf_dir)))
    return id_index.drop_indexed(spark, f"{folder}/lake", new).select("event_id", "created_at")


def _stream_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through the file stream."""
    folder = _fresh_folder(spark)
    feed = raw_feed(spark, sf_dir, source_file=_daily_file(), stamped=False)
    land_events(feed.select("value"), f"{folder}/raw", ingest_ts=STAMP)
    stream_load(
        spark, f"{folder}/raw", f"{folder}/lake", f"{folder}/checkpoint"
    ).awaitTermination()
    return _stored_columns(read_events(spark, f"{folder}/lake"))


def _stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sessions by the streaming operator; complete mode shows open ones."""
    folder = _fresh_folder(spark)
    table = (
        spark.readStream.schema(SCHEMA)
        .option("pathGlobFilter", "events.parquet")
        .parquet(sf_dir)
    )
    query = (
        stream_sessions(adapt(table), lateness="3650 days")
        .writeStream.outputMode("complete")
        .foreachBatch(
            lambda batch, _: batch.write.mode("overwrite").parquet(f"{folder}/out")
        )
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.parquet(f"{folder}/out")


def _stream_numbered_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed sessions with their numbers, in append mode; open ones are not given."""
    folder = _fresh_folder(spark)
    table = (
        spark.readStream.schema(SCHEMA)
        .option("pathGlobFilter", "events.parquet")
        .parquet(sf_dir)
    )
    places = [f"{folder}/{name}" for name in ("sessions", "late", "checkpoint")]
    write_numbered_sessions(adapt(table), *places).awaitTermination()
    return spark.read.parquet(places[0]).drop("batch")


def _llm() -> tuple[dict[str, Query], dict[str, str]]:
    """Queries and SQL of the optional subpackage; nothing where it is absent."""
    try:
        from corpus_pipeline import ORACLE_SQL, run
        from logweir.llm.queries import ORACLES, QUERIES
    except ImportError:
        return {}, {}
    sql = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
    return QUERIES | {"pipeline": run}, ORACLES | sql


def queries() -> dict[str, Query]:
    return {
        **_llm()[0],
        "event_count": _on_events(explore.event_count),
        "events_per_type": _on_events(explore.events_per_type),
        "repo_counts": _on_events(explore.repo_counts),
        "events_per_hour": _on_events(explore.events_per_hour),
        "most_active_users": _on_events(explore.most_active_users),
        "recent_repo_events": _on_events(
            lambda events: explore.recent_repo_events(events, "org/repo7")
        ),
        "top_repos_7d": _ranked(7),
        "top_repos_30d": _ranked(30),
        "event_sequence": _steps("actor_login", "created_at", "event_sequence"),
        "session_breaks": _steps("created_at", "prev_created_at", "is_new_session"),
        "session_ids": _steps("actor_login", "session_id"),
        "user_sessions": _on_events(
            lambda events: sessions.user_sessions(
                events, days=7, limit=None, as_of=AS_OF
            )
        ),
        "user_sessions_top50": _on_events(
            lambda events: sessions.user_sessions(
                events, days=30, limit=50, as_of=AS_OF
            )
        ),
        "nested_v1_flat": _flat(1),
        "nested_v2_flat": _flat(2),
        "nested_len": _on_events(
            lambda events: nested.list_lengths(nested.repo_events_nested_parts(events))
        ),
        "nested_first_last": _on_events(
            lambda events: nested.first_and_last(
                nested.repo_events_nested_parts(events)
            )
        ),
        "land_enrich": _land_enrich,
        "load_parse": _load_parse,
        "load_payload": _load_payload,
        "load_validate": _load_validate,
        "load_file_atomic": _load_file_atomic,
        "load_dedup": _load_dedup,
        "load_anti_join": _load_anti_join,
        "manifest_classify": _manifest_classify,
        "manifest_latest": _manifest_latest,
        "load_report": _load_report,
        "load_end_to_end": _load_end_to_end,
        "load_compact": _load_compact,
        "load_id_index": _load_id_index,
        "load_odd_names": _load_odd_names,
        "stream_load": _stream_load,
        "stream_sessions": _stream_sessions,
        "stream_numbered_sessions": _stream_numbered_sessions,
    }


# --- the same in SQL -----------------------------------------------------------

_EVENTS = """
    SELECT CAST(event_id AS VARCHAR) AS event_id,
           event_type,
           ts AS created_at,
           CAST(user_id AS INTEGER) AS actor_id,
           'user_' || user_id AS actor_login,
           CAST(json_extract_string(props, '$.k') AS INTEGER) AS repo_id,
           'org/repo' || json_extract_string(props, '$.k') AS repo_name
    FROM events
"""

_WITH_EVENTS = f"WITH e AS ({_EVENTS})"


def _top_repos_sql(days: int) -> str:
    return f"""{_WITH_EVENTS}
    SELECT repo_name,
           count(*) AS total_events,
           count(DISTINCT actor_login) AS unique_users,
           count(CASE WHEN event_type = '{PUSH}' THEN 1 END) AS push_events,
           min(created_at) AS first_event_at,
           max(created_at) AS last_event_at
    FROM e
    WHERE created_at > TIMESTAMP '2024-01-31 00:00:00' - INTERVAL {days} DAY
    GROUP BY repo_name
    ORDER BY total_events DESC, repo_name
    LIMIT 10"""


def _session_steps_sql(days: int) -> str:
    """CTEs ``sequenced``, ``breaks`` and ``ids`` over the scanned events."""
    start = f"TIMESTAMP '2024-01-31 00:00:00' - INTERVAL {days} DAY"
    return f"""{_WITH_EVENTS},
    sequenced AS (
        SELECT event_id, actor_login, created_at,
               row_number() OVER a AS event_sequence,
               lag(created_at) OVER a AS prev_created_at
        FROM e
        WHERE actor_login IS NOT NULL
          AND created_at >= {start} - INTERVAL 30 MINUTE
        WINDOW a AS (PARTITION BY actor_login ORDER BY created_at, event_id)
    ),
    breaks AS (
        SELECT *, CASE WHEN prev_created_at IS NULL
                         OR created_at - prev_created_at > INTERVAL 30 MINUTE
                       THEN 1 ELSE 0 END AS is_new_session
        FROM sequenced
    ),
    ids AS (
        SELECT *, CAST(sum(is_new_session) OVER (
                      PARTITION BY actor_login ORDER BY created_at, event_id
                  ) AS BIGINT) AS session_id
        FROM breaks
    ),
    totals AS (
        SELECT actor_login, session_id,
               min(created_at) AS session_start_at,
               max(created_at) AS session_end_at,
               count(*) AS events_in_session
        FROM ids
        GROUP BY actor_login, session_id
    ),
    recent AS (SELECT * FROM totals WHERE session_end_at >= {start})"""


def _nested_flat_sql(extra: str) -> str:
    return f"""{_WITH_EVENTS}
    SELECT repo_name,
           row_number() OVER (
               PARTITION BY repo_name ORDER BY created_at, event_id
           ) AS position,
           event_id, actor_login, event_type, created_at{extra}
    FROM e"""


_NESTED = f"""{_WITH_EVENTS},
    n AS (
        SELECT repo_name,
               list(struct_pack(event_id := event_id, repo_id := repo_id)
                    ORDER BY created_at, event_id) AS events
        FROM e GROUP BY repo_name
    )"""


def _iso_sql(moment: str) -> str:
    return f"replace(CAST({moment} AS VARCHAR), ' ', 'T') || 'Z'"


def _line_sql(end: str) -> str:
    k = "json_extract_string(props, '$.k')"
    return f"""'{{"id":"' || event_id || '","type":"' || event_type
        || '","created_at":"' || {_iso_sql("ts")}
        || '","actor":{{"id":' || user_id || ',"login":"user_' || user_id
        || '"}},"repo":{{"id":' || {k} || ',"name":"org/repo' || {k}
        || '"}},"payload":' || props || ',"public":true' || {end} || '}}'"""


_DAY = "strftime(ts, '%Y-%m-%d')"
_USER_DAY_FILE = f"'events_' || {_DAY} || '_user_' || user_id || '.jsonl'"
_STAMPED = "',\"_ingested_at\":\"2024-02-01T00:00:00Z\"'"

_STATUS = """CASE WHEN value > 200 AND event_type = 'error' THEN 'fatal'
                WHEN value > 200 AND event_type IN ('signup', 'view') THEN 'violating'
                ELSE 'ok' END"""

_LOADED = f"""{_WITH_EVENTS},
    lines AS (
        SELECT CAST(event_id AS VARCHAR) AS event_id, {_line_sql(_STAMPED)} AS raw
        FROM events
    )
    SELECT e.*, TIMESTAMP '2024-02-01 00:00:00' AS ingested_at,
           '{{"k":' || repo_id || '}}' AS payload, raw
    FROM e JOIN lines USING (event_id)"""

_CLASSIFIED = f"""WITH files AS (
        SELECT {_USER_DAY_FILE} AS file_path,
               CAST(ts AS DATE) AS day,
               sum(event_id) AS whole,
               sum(CASE WHEN event_type <> 'error' THEN event_id END) AS known
        FROM events
        GROUP BY ALL
    ),
    classified AS (
        SELECT file_path,
               CASE WHEN day > DATE '2024-01-15' OR known IS NULL THEN 'new'
                    WHEN known = whole THEN 'unchanged'
                    ELSE 'modified' END AS status
        FROM files
    )"""


def oracle_sql() -> dict[str, str]:
    return {
        **_llm()[1],
        "event_count": f"{_WITH_EVENTS} SELECT count(*) AS event_count FROM e",
        "events_per_type": f"""{_WITH_EVENTS}
            SELECT event_type, count(*) AS "count" FROM e GROUP BY event_type""",
        "repo_counts": f"""{_WITH_EVENTS}
            SELECT repo_name, count(*) AS event_count FROM e
            WHERE repo_name IS NOT NULL GROUP BY repo_name
            ORDER BY event_count DESC, repo_name LIMIT 10""",
        "events_per_hour": f"""{_WITH_EVENTS}
            SELECT date_trunc('hour', created_at) AS "hour", count(*) AS event_count
            FROM e GROUP BY 1 ORDER BY 1 DESC LIMIT 24""",
        "most_active_users": f"""{_WITH_EVENTS}
            SELECT actor_login, count(*) AS event_count FROM e
            WHERE actor_login IS NOT NULL GROUP BY actor_login
            ORDER BY event_count DESC, actor_login LIMIT 10""",
        "recent_repo_events": f"""{_WITH_EVENTS}
            SELECT event_id, event_type, actor_login, created_at FROM e
            WHERE repo_name = 'org/repo7'
            ORDER BY created_at DESC, event_id DESC LIMIT 20""",
        "top_repos_7d": _top_repos_sql(7),
        "top_repos_30d": _top_repos_sql(30),
        "event_sequence": f"""{_session_steps_sql(30)}
            SELECT event_id, actor_login, created_at, event_sequence FROM ids""",
        "session_breaks": f"""{_session_steps_sql(30)}
            SELECT event_id, created_at, prev_created_at, is_new_session FROM ids""",
        "session_ids": f"""{_session_steps_sql(30)}
            SELECT event_id, actor_login, session_id FROM ids""",
        "user_sessions": f"{_session_steps_sql(7)} SELECT * FROM recent",
        "user_sessions_top50": f"""{_session_steps_sql(30)}
            SELECT * FROM recent
            ORDER BY actor_login, session_start_at DESC LIMIT 50""",
        "nested_v1_flat": _nested_flat_sql(""),
        "nested_v2_flat": _nested_flat_sql(", repo_id"),
        "nested_len": f"""{_NESTED}
            SELECT repo_name, len(events) AS events_in_list FROM n""",
        "nested_first_last": f"""{_NESTED}
            SELECT repo_name,
                   events[1].event_id AS first_event_id,
                   events[1].repo_id AS first_repo_id,
                   events[len(events)].event_id AS last_event_id
            FROM n""",
        "land_enrich": f"SELECT event_id, {_line_sql(_STAMPED)} AS value FROM events",
        "load_parse": f"""{_WITH_EVENTS},
            lines AS (
                SELECT CAST(event_id AS VARCHAR) AS event_id,
                       ts + INTERVAL 5 MINUTE AS ingested_at,
                       'events_' || {_DAY} || '.jsonl' AS source_file,
                       {_line_sql("',\"_ingested_at\":\"' || " + _iso_sql("(ts + INTERVAL 5 MINUTE)") + " || '\"'")} AS raw
                FROM events
            )
            SELECT e.*, ingested_at, source_file,
                   '{{"k":' || repo_id || '}}' AS payload, raw
            FROM e JOIN lines USING (event_id)""",
        "load_payload": """
            SELECT CAST(event_id AS VARCHAR) AS event_id,
                   CASE event_type
                       WHEN 'purchase' THEN replace(props, ' ', '')
                       WHEN 'signup' THEN '"0"'
                   END AS payload
            FROM events""",
        "load_validate": f"""
            SELECT {_USER_DAY_FILE} AS source_file, event_id AS line,
                   {_STATUS} AS status
            FROM events""",
        "load_file_atomic": f"""
            WITH lines AS (
                SELECT CAST(event_id AS VARCHAR) AS event_id, ts,
                       {_USER_DAY_FILE} AS source_file, {_STATUS} AS status
                FROM events
            )
            SELECT event_id, source_file FROM lines
            WHERE status = 'ok' AND source_file NOT IN (
                SELECT source_file FROM lines
                WHERE status = 'fatal'
                   OR (status = 'violating' AND ts >= TIMESTAMP '2024-01-16 00:00:00')
            )""",
        "load_dedup": f"""
            SELECT CAST(event_id AS VARCHAR) AS event_id,
                   least('events_' || {_DAY} || '.jsonl',
                         'events_2024-01-' || strftime(ts, '%H') || '_again.jsonl')
                       AS source_file,
                   ts AS created_at
            FROM events""",
        "load_anti_join": """
            SELECT CAST(event_id AS VARCHAR) AS event_id, ts AS created_at
            FROM events WHERE ts >= TIMESTAMP '2024-01-16 00:00:00'""",
        "manifest_classify": f"{_CLASSIFIED} SELECT file_path, status FROM classified",
        "manifest_latest": """
            SELECT 'user_' || user_id || '.jsonl' AS file_path, ts AS loaded_at,
                   sha256(props) AS file_sha256
            FROM events
            QUALIFY row_number() OVER (
                PARTITION BY user_id ORDER BY ts DESC, sha256(props) DESC) = 1""",
        "load_report": """
            SELECT 1 AS run, true AS all_loaded, false AS all_skipped,
                   true AS all_counted, count(*) AS inserted_events FROM events
            UNION ALL SELECT 2, false, true, true, 0""",
        "load_end_to_end": _LOADED,
        "load_compact": f"""SELECT *, 3 AS replaced, CAST(1 AS BIGINT) AS batches
            FROM ({_LOADED})""",
        "load_id_index": """
            SELECT CAST(event_id AS VARCHAR) AS event_id, ts AS created_at
            FROM events WHERE ts >= TIMESTAMP '2024-01-16 00:00:00'""",
        "load_odd_names": f"SELECT * FROM ({_LOADED}) WHERE CAST(event_id AS BIGINT) % 2 = 0",
        "stream_load": _LOADED,
        "stream_sessions": f"""{_WITH_EVENTS},
            sequenced AS (
                SELECT *, lag(created_at) OVER (
                    PARTITION BY actor_login ORDER BY created_at, event_id
                ) AS before
                FROM e
            ),
            ids AS (
                SELECT *, sum(CASE WHEN created_at - before <= INTERVAL 30 MINUTE
                                   THEN 0 ELSE 1 END) OVER (
                    PARTITION BY actor_login ORDER BY created_at, event_id
                ) AS session
                FROM sequenced
            )
            SELECT actor_login,
                   min(created_at) AS session_start_at,
                   max(created_at) AS session_end_at,
                   count(*) AS events_in_session
            FROM ids GROUP BY actor_login, session""",
        "stream_numbered_sessions": f"""{_WITH_EVENTS},
            sequenced AS (
                SELECT *, lag(created_at) OVER (
                    PARTITION BY actor_login ORDER BY created_at, event_id
                ) AS before
                FROM e
            ),
            ids AS (
                SELECT *, CAST(sum(CASE WHEN created_at - before <= INTERVAL 30 MINUTE
                                        THEN 0 ELSE 1 END) OVER (
                    PARTITION BY actor_login ORDER BY created_at, event_id
                ) AS BIGINT) AS session_id
                FROM sequenced
            )
            SELECT actor_login, session_id,
                   min(created_at) AS session_start_at,
                   max(created_at) AS session_end_at,
                   count(*) AS events_in_session
            FROM ids GROUP BY actor_login, session_id
            HAVING max(created_at) + INTERVAL 40 MINUTE < (SELECT max(created_at) FROM e)""",
    }
