from .ingest import checkpoint_table, drained, stream_ingest, stream_objects
from .objects import listed_stream
from .records import stream_bad_files, stream_dedup, stream_events, stream_log_files, stream_write
from .progress import ProgressLog
from .state import stream_checkpoints, stream_files, stream_state

__all__ = [
    "ProgressLog", "checkpoint_table", "drained", "listed_stream", "stream_bad_files", "stream_checkpoints",
    "stream_dedup", "stream_events", "stream_files", "stream_ingest", "stream_log_files", "stream_objects",
    "stream_state", "stream_write",
]
