"""Settings of an ingest, and the trail list it works on."""

from dataclasses import dataclass
from typing import Literal, NamedTuple


class Trail(NamedTuple):
    name: str
    bucket: str
    prefix: str = ""


@dataclass(frozen=True)
class IngestOptions:
    # Turns a trail's bucket into a load path.
    bucket_uri: str = "s3a://{bucket}"
    # Most lines in one output file.
    events_per_file: int = 10_000
    # Listed files between two checkpoint marks.
    checkpoint_every: int = 100
    # Both are exact. "exact" compares with every id written before; "approx" asks a Bloom
    # sketch first and compares only what it may hold, so that most ids are not read.
    dedup: Literal["exact", "approx"] = "approx"
    # Ids that the sketch of one run is made for; four times as many, and so on, if it has more.
    bloom_items: int = 1_000_000
    bloom_fpp: float = 0.001
    # Streams only: "file_log" reads every new file; "high_water" leaves out keys at or
    # below the last one of their pair when the query started, as a batch run does.
    late: Literal["file_log", "high_water"] = "file_log"
    # Streams only, how objects are found: "files" is Spark's file source, which lists whole trails at
    # every trigger; "offsets" asks only folders at or behind the last key of each pair, less
    # `look_back_days` for late keys.
    listing: Literal["files", "offsets"] = "files"
    look_back_days: int = 2
    # A record of wrong JSON type in a read field is malformed.
    strict: bool = True
    # True keeps every record without an id; False lets only the first one through.
    keep_missing_ids: bool = False
    # True also asks for 12 digits below an organization folder.
    strict_accounts: bool = False
    # True compares only with ids of the same event date (repeats carry the same time).
    prune_by_date: bool = False
    # Folders of log files that are listed at a time.
    list_folders: int = 1_000
    # Files of one run; what is left over is the next run's work.
    max_files: int = 100_000
    # A file that could not be read is tried again after this time, then after twice as
    # long and so on, a day at most.
    retry_seconds: int = 300
    # After so many tries a file waits for `requeue_files`; None tries without end.
    give_up_after: int | None = None
    # A run that did not renew its claim for so long no longer keeps others out.
    claim_hours: float = 6.0
    # Between two progress lines of a run.
    progress_seconds: float = 10.0
    flush_seconds: int = 30
    # Runs after which the ids of all runs so far are merged into one folder; also after a run that
    # had to ask more sketches than this, one after another.
    compact_every: int = 100
    most_sketches: int = 8
    # Also after a run when more folders of ids than this came since the last merging: each run that finds
    # known events opens them all.
    most_id_folders: int = 256
    # Folders a run's ids are dealt to by ranges of a hash; may change between runs.
    id_buckets: int = 16
