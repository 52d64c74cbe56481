from logweir.streaming.file_loader import stream_load
from logweir.streaming.numbered import numbered_sessions, write_numbered_sessions
from logweir.streaming.sessions import stream_sessions

__all__ = ["numbered_sessions", "stream_load", "stream_sessions", "write_numbered_sessions"]
