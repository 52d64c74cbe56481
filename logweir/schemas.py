"""Fixed schemas: the JSON fields read from a line, and the stored tables."""

from pyspark.sql import types as T

# Leaves are strings so that a wrong value never spoils its neighbours; they
# are cast one by one afterwards.
RAW_EVENT = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("created_at", T.StringType()),
        T.StructField("_ingested_at", T.StringType()),
        T.StructField(
            "actor",
            T.StructType(
                [
                    T.StructField("id", T.StringType()),
                    T.StructField("login", T.StringType()),
                ]
            ),
        ),
        T.StructField(
            "repo",
            T.StructType(
                [
                    T.StructField("id", T.StringType()),
                    T.StructField("name", T.StringType()),
                ]
            ),
        ),
        T.StructField("payload", T.StringType()),
    ]
)

EVENTS = T.StructType(
    [
        T.StructField("event_id", T.StringType(), False),
        T.StructField("event_type", T.StringType(), False),
        T.StructField("created_at", T.TimestampNTZType(), False),
        T.StructField("ingested_at", T.TimestampNTZType(), False),
        T.StructField("actor_id", T.IntegerType()),
        T.StructField("actor_login", T.StringType()),
        T.StructField("repo_id", T.IntegerType()),
        T.StructField("repo_name", T.StringType()),
        T.StructField("payload", T.StringType()),
        T.StructField("raw", T.StringType(), False),
        T.StructField("source_file", T.StringType(), False),
        T.StructField("loaded_at", T.TimestampNTZType(), False),
    ]
)

# How events lie on disk: the load that wrote them, then the day they happened.
EVENTS_LAYOUT = T.StructType(
    EVENTS.fields
    + [
        T.StructField("batch_id", T.StringType()),
        T.StructField("created_date", T.DateType()),
    ]
)

LOADED_FILES = T.StructType(
    [
        T.StructField("file_path", T.StringType(), False),
        T.StructField("file_size", T.LongType(), False),
        T.StructField("file_mtime", T.TimestampNTZType(), False),
        T.StructField("file_sha256", T.StringType(), False),
        T.StructField("loaded_at", T.TimestampNTZType(), False),
        T.StructField("batch_id", T.StringType(), False),
    ]
)

REJECTED_FILES = T.StructType(
    [
        T.StructField("file_path", T.StringType()),
        T.StructField("reason", T.StringType()),
        T.StructField("rejected_at", T.TimestampNTZType()),
    ]
)

# Landed folders that were loaded whole.
LANDED_FOLDERS = T.StructType(
    [
        T.StructField("folder", T.StringType()),
        T.StructField("files", T.LongType()),
        T.StructField("recorded_at", T.TimestampNTZType()),
    ]
)

# Batches that a compaction replaced by a new one.
COMPACTIONS = T.StructType(
    [
        T.StructField("batch_id", T.StringType()),
        T.StructField("replaced_id", T.StringType()),
        T.StructField("compacted_at", T.TimestampNTZType()),
    ]
)

# Batches whose ids are in a generation of the id index.
INDEXED_BATCHES = T.StructType(
    [
        T.StructField("generation", T.StringType()),
        T.StructField("buckets", T.IntegerType()),
        T.StructField("batch_id", T.StringType()),
    ]
)

EVENT_IDS = "event_id STRING, batch_id STRING"

ONLY_IDS = T.StructType([T.StructField("event_id", T.StringType())])
