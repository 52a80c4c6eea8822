"""Counters of a run."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.naming import route_key
from ..schemas import COUNTERS
from .records import REJECT_REASONS


def reject_counts(records: DataFrame) -> DataFrame:
    """Records per outcome of `classify_records`; 'ok' for the good ones."""
    return (records.groupBy(F.coalesce("reject_reason", F.lit("ok")).alias("outcome"))
            .agg(F.count(F.lit(1)).alias("events")))


def observe_outcomes(records: DataFrame, name: str = "outcomes") -> DataFrame:
    """The same rows; their outcomes are counted on the way, for progress reports.

    A repeated task counts again, so the counters of a run are not taken from here.
    """
    reason = F.col("reject_reason")
    return records.observe(
        name, F.count(F.lit(1)).alias("events"),
        *[F.count_if(reason == r).alias(r) for r in REJECT_REASONS])


def event_metrics(groups: DataFrame, hour_buffers: int | None = None) -> DataFrame:
    """Event counters from groups of equal records.

    `copies` rows stand behind each group; `reject_reason` is set for unusable
    ones, `is_seen` for ids of earlier runs. `hour_buffers` is the number of hours written, where
    the groups do not have their route.
    """
    good = F.col("reject_reason").isNull()
    new = good & ~F.col("is_seen")

    def rows(cond):
        return F.coalesce(F.sum(F.when(cond, F.col("copies"))), F.lit(0))

    return groups.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("events_processed"),
        F.count_if(new).alias("events_written"),
        (rows(good) - F.count_if(new)).alias("events_duplicate"),
        *[rows(F.col("reject_reason") == r).alias(f"events_{r}") for r in REJECT_REASONS],
        (F.count_distinct(F.when(new, route_key())) if hour_buffers is None
         else F.max(F.lit(hour_buffers).cast("bigint"))).alias("hour_buffers"),
    )


def file_metrics(files: DataFrame) -> DataFrame:
    """File counters from listed files with `size`, `attempts` before this run, `downloaded` and `failed`.

    A file that is tried again was listed by an earlier run. One that vanished or could not be
    unpacked was not downloaded.
    """
    got = F.col("downloaded")
    return files.agg(
        F.count_if(F.col("attempts") == 0).alias("files_listed"),
        F.count_if(got).alias("files_downloaded"),
        F.count_if(~F.col("failed")).alias("files_processed"),
        F.coalesce(F.sum(F.when(got, F.col("size"))), F.lit(0)).alias("bytes_downloaded"),
        F.count_if(F.col("failed")).alias("errors"),
    )


def run_metrics(groups: DataFrame, files: DataFrame, jsonl_files: int = 0,
                hour_buffers: int | None = None) -> DataFrame:
    """All counters in one row; `jsonl_files` is the number of files the sink wrote."""
    parts = event_metrics(groups, hour_buffers).unionByName(file_metrics(files), allowMissingColumns=True)
    parts = parts.withColumn("jsonl_files", F.when(F.col("files_listed").isNotNull(), F.lit(jsonl_files).cast("bigint")))
    return parts.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTERS])
