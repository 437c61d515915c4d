from millrace.streaming.jobs import StreamResult, run_stream
from millrace.streaming.sessions import batch_sessions, split_late, stream_sessions

__all__ = ["StreamResult", "batch_sessions", "run_stream", "split_late", "stream_sessions"]
