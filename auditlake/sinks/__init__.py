from .events import event_lines, merge_hours, write_events, write_manifest
from .tables import (Claimed, claimed, compact_seen, drop_run, write_checkpoints, write_failed_files, write_layer,
                     write_metrics, write_seen)

__all__ = [
    "Claimed", "claimed", "compact_seen", "drop_run", "event_lines", "merge_hours", "write_checkpoints",
    "write_events", "write_failed_files", "write_layer", "write_manifest", "write_metrics", "write_seen",
]
