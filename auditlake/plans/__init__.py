from .ingest import ingest_batch, ingest_objects, requeue_files

__all__ = ["ingest_batch", "ingest_objects", "requeue_files"]
