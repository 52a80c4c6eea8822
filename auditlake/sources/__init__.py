from .events import event_files, read_events
from .known_ids import known_among, known_layers, probe_layers
from .listing import as_trails, bucket_root, list_objects, trails_df
from .log_files import explode_records, read_log_files
from .tables import committed_runs, read_checkpoints, read_failed_files, read_metrics, read_seen

__all__ = [
    "as_trails", "bucket_root", "committed_runs", "event_files", "explode_records", "known_among", "known_layers", "list_objects",
    "probe_layers", "read_checkpoints", "read_events", "read_failed_files", "read_log_files", "read_metrics",
    "read_seen", "trails_df",
]
