from logweir.functions.jsonlines import add_ingested_at, payload_text, split_response
from logweir.functions.time import hour_of, ntz, positive, since, window_start

__all__ = [
    "add_ingested_at",
    "hour_of",
    "ntz",
    "payload_text",
    "positive",
    "since",
    "split_response",
    "window_start",
]
