"""Incremental, deduplicating ingestion of audit-trail logs on Spark."""

from .options import IngestOptions, Trail
from .plans import ingest_batch, ingest_objects, requeue_files
from .sinks import merge_hours

__all__ = ["IngestOptions", "Trail", "ingest_batch", "ingest_objects", "merge_hours", "requeue_files"]
