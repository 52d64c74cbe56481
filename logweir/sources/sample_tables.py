"""The shared test table ``events.parquet`` in the library's shapes.

The table holds ``event_id, ts, user_id, event_type, value, props`` with props
like ``{"k": 7}``; users become actors and ``k`` becomes the repository.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


SCHEMA = (
    "event_id long, ts timestamp_ntz, user_id long, event_type string, "
    "value double, props string"
)


def sample_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(f"{sf_dir}/events.parquet")


def canonical_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapt(sample_table(spark, sf_dir))


def adapt(table: DataFrame) -> DataFrame:
    """``k`` is read from the JSON once; other keys and spacing do not matter."""
    known = table.withColumn("k", F.get_json_object("props", "$.k"))
    return known.selectExpr(
        "CAST(event_id AS STRING) AS event_id",
        "event_type",
        "ts AS created_at",
        "CAST(user_id AS INT) AS actor_id",
        "concat('user_', user_id) AS actor_login",
        "CAST(k AS INT) AS repo_id",
        "concat('org/repo', k) AS repo_name",
        "props AS payload",
    )


def iso(moment: Column) -> Column:
    return F.concat(F.replace(moment.cast("string"), F.lit(" "), F.lit("T")), F.lit("Z"))


def raw_feed(
    spark: SparkSession,
    sf_dir: str,
    *,
    source_file: Column,
    payload: Column | None = None,
    actor_id: Column | None = None,
    created_at: Column | None = None,
    stamped: bool = True,
) -> DataFrame:
    """Every event as a JSON line in the file named by ``source_file``."""
    ingested = F.concat(
        F.lit(',"_ingested_at":"'),
        iso(F.col("ts") + F.expr("INTERVAL 5 MINUTES")),
        F.lit('"'),
    )
    repo_number = F.col("k")
    line = F.concat(
        F.lit('{"id":"'),
        "event_id",
        F.lit('","type":"'),
        "event_type",
        F.lit('","created_at":'),
        F.concat(F.lit('"'), iso(F.col("ts")), F.lit('"'))
        if created_at is None
        else created_at,
        F.lit(',"actor":{"id":'),
        F.col("user_id").cast("string") if actor_id is None else actor_id,
        F.lit(',"login":"user_'),
        "user_id",
        F.lit('"},"repo":{"id":'),
        repo_number,
        F.lit(',"name":"org/repo'),
        repo_number,
        F.lit('"},"payload":'),
        F.col("props") if payload is None else payload,
        F.lit(',"public":true'),
        ingested if stamped else F.lit(""),
        F.lit("}"),
    )
    table = sample_table(spark, sf_dir)
    return table.withColumn("k", F.get_json_object("props", "$.k")).select(
        line.alias("value"),
        source_file.alias("source_file"),
        F.lit(0).cast("long").alias("block_start"),
        F.col("event_id").alias("line"),
    )
