from .bloom import bloom_build, bloom_merge, bloom_probe, bloom_size
from .checkpoints import (advance_checkpoints, checkpoint_marks, merge_checkpoints, pending_objects)
from .dedup import dedup_first, drop_seen, mark_duplicates, union_trails
from .discovery import discover_account_regions, discover_accounts, log_objects
from .losers import loser_bitmaps, scan_ranges, without_losers
from .metrics import observe_outcomes, reject_counts, run_metrics
from .numbering import assign_file_no
from .records import classify_records, reject_files

__all__ = [
    "advance_checkpoints", "assign_file_no", "bloom_build", "bloom_merge", "bloom_probe",
    "bloom_size", "checkpoint_marks", "classify_records", "dedup_first",
    "discover_account_regions", "discover_accounts", "drop_seen", "log_objects", "loser_bitmaps",
    "mark_duplicates", "merge_checkpoints", "observe_outcomes", "pending_objects", "reject_counts",
    "reject_files", "run_metrics", "scan_ranges", "union_trails", "without_losers",
]
