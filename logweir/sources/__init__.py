from logweir.sources.lake import read_events, read_manifest
from logweir.sources.landing import land_events
from logweir.sources.loader import LoadResult, load_events

__all__ = ["LoadResult", "land_events", "load_events", "read_events", "read_manifest"]
