"""Raw JSON lines by account, region and hour."""

import uuid
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.paths import decoded
from ..options import IngestOptions
from ..schemas import MANIFEST, ROUTE
from ..session import create_file, drop_folder, read_file, run_folders, scratch_folder, small_files
from ..sources.events import committed_merges, event_files, event_lines_in, read_replaced
from ..sources.tables import table_path
from .tables import claimed, drop_run

#: Events that may be the work of one task, were they all of one hour.
FEW_EVENTS = 100_000
#: Hours of one merge, and files, whose names and places are broadcast.
MERGED_HOURS, MERGED_FILES = 1_000, 100_000


def event_lines(events: DataFrame) -> DataFrame:
    """The text column and its partition columns.

    Line breaks of a pretty-printed record become spaces; inside JSON strings raw
    breaks cannot occur, so the value stays the same.
    """
    return events.select(F.translate("raw", "\n\r", "  ").alias("value"), *ROUTE)


def write_events(events: DataFrame, path: str, events_per_file: int = 10_000, mode: str = "overwrite",
                 count: int | None = None) -> None:
    """Write lines below `account_id=/region=/year=/month=/day=/hour=`.

    The rebalance brings an hour's events together for large files, and unlike a
    repartition by the route it splits a busy account over many tasks. Few events (`count` says so) it would
    bring to one task, which then opens the files of all hours one after another: those are dealt to as many
    tasks as there are cores.
    """
    lines = event_lines(events)
    if count is not None and count <= FEW_EVENTS:
        lines = lines.repartition(max(events.sparkSession.sparkContext.defaultParallelism, 1), *ROUTE)
    else:
        lines = lines.hint("rebalance", *ROUTE)
    (lines.write.mode(mode).partitionBy(*ROUTE)
     .option("maxRecordsPerFile", events_per_file).text(path))


class Written(NamedTuple):
    rows: int
    files: int
    folders: int


def write_manifest(spark: SparkSession, root: str, run_id: str) -> Written:
    """The files that `write_events` wrote for a run, their lines read back and counted."""
    path = table_path(root, "manifest", run_id)
    lines = event_lines_in(spark, root, [f"run_id={run_id}"], pathGlobFilter="part-*")
    if lines is None:
        spark.createDataFrame([], StructType([f for f in MANIFEST.fields if f.name != "run_id"])).write.mode("overwrite").parquet(path)
        return Written(0, 0, 0)
    folder = F.regexp_extract(decoded("_metadata.file_path"), "/(account_id=.*)/[^/]*$", 1)
    files = (lines.select(folder.alias("folder"), *ROUTE, F.col("_metadata.file_name").alias("file"),
                          F.col("_metadata.file_size").alias("bytes"))
             .groupBy("folder", *ROUTE, "file", "bytes").agg(F.count(F.lit(1)).alias("rows")))
    files.withColumn("region", F.coalesce("region", F.lit(""))).write.mode("overwrite").parquet(path)
    return Written(*spark.read.parquet(path).agg(F.coalesce(F.sum("rows"), F.lit(0)), F.count(F.lit(1)),
                                                 F.count_distinct("folder")).first())


def merge_hours(spark: SparkSession, root: str, options: IngestOptions = IngestOptions(), where: Column | None = None) -> int:
    """Write hours anew that lie in more files than their events need; how many.

    An hour gets files from every run that brings events of it. Those that meet `where` (a condition on the
    route: hours that are cold) are filled up to `events_per_file` lines, many hours in one commit; a
    reader sees the old files or the new ones. Old files go with the next call, when no reader can be at
    them any more. Runs can go on meanwhile; two merges at a time cannot.
    """
    merged = 0
    _drop_replaced(spark, root)
    while True:
        merges = committed_merges(spark, root)
        seq = merges[-1][0] + 1 if merges else 1
        name = f"merge-{seq:08d}-{uuid.uuid4().hex[:8]}"
        with claimed(spark, root, seq, options.claim_hours, "merge_") as lease:
            try:
                with run_folders(spark), small_files(spark):
                    done = _merge_some(spark, root, name, options, where)
                if not done:
                    return merged
                lease.commit(name)
            except BaseException:
                drop_run(spark, root, name)
                raise
        merged += done


def _merge_some(spark, root, name, options, where) -> int:
    """Merge some hours as the run `name`, not committed yet."""
    files = event_files(spark, root).filter(F.lit(True) if where is None else where)
    needed = F.ceil(F.sum("rows") / options.events_per_file)
    hours = (files.groupBy(*ROUTE).agg(F.count(F.lit(1)).alias("files"), needed.alias("needed"))
             .filter(F.col("files") > F.col("needed")).orderBy(*ROUTE).limit(MERGED_HOURS).collect())
    chosen, size = [], 0
    for h in hours:
        if chosen and size + h.files > MERGED_FILES:
            break
        chosen.append(tuple(h[c] for c in ROUTE))
        size += h.files
    if not chosen:
        return 0
    with scratch_folder(spark, "merge") as work:
        picked = spark.createDataFrame(chosen, ", ".join(f"{c} string" for c in ROUTE))
        before = Window.partitionBy(*ROUTE).orderBy("run_id", "file").rowsBetween(Window.unboundedPreceding, -1)
        (files.join(F.broadcast(picked), ROUTE, "left_semi")
         .withColumn("first", F.coalesce(F.sum("rows").over(before), F.lit(0))).write.parquet(work))
        old = spark.read.parquet(work)
        folders = old.select("run_id", "folder").distinct()
        texts = event_lines_in(spark, root, [f"run_id={r.run_id}/{r.folder}" for r in folders.collect()],
                               wholetext=True, pathGlobFilter="part-*")
        # A file has at most `events_per_file` lines. Read as one value, each line knows its number.
        places = old.select("run_id", "folder", "file", "first")
        named = texts.select("value", "run_id", *ROUTE, F.col("_metadata.file_name").alias("file"),
                             F.regexp_extract(decoded("_metadata.file_path"), "/(account_id=.*)/[^/]*$", 1).alias("folder"))
        lines = (named.join(F.broadcast(places), ["run_id", "folder", "file"])
                 .select(*ROUTE, "first", F.posexplode(F.split(F.regexp_replace("value", "\n\\z", ""), "\n")).alias("at", "value"))
                 .withColumn("bin", F.floor((F.col("first") + F.col("at")) / options.events_per_file)))
        (lines.repartition(*ROUTE, "bin").sortWithinPartitions(*ROUTE, "bin").select("value", *ROUTE)
         .write.mode("overwrite").partitionBy(*ROUTE).option("maxRecordsPerFile", options.events_per_file)
         .text(table_path(root, "events", name)))
        wanted, written = old.agg(F.sum("rows")).first()[0], write_manifest(spark, root, name).rows
        if wanted != written:
            raise RuntimeError(f"{name} wrote {written} of {wanted} events")
        (folders.select(F.col("run_id").alias("old_run"), "folder").coalesce(1)
         .write.mode("overwrite").parquet(table_path(root, "replaced", name)))
    return len(chosen)


def _drop_replaced(spark: SparkSession, root: str) -> None:
    """The hour folders that earlier merges replaced, each merge's once."""
    for _, name in committed_merges(spark, root):
        mark = f"{table_path(root, 'merge_cleaned')}/{name}"
        if read_file(spark, mark) is None:
            for r in read_replaced(spark, root, [name]).collect():
                drop_folder(spark, f"{table_path(root, 'events', r.old_run)}/{r.folder}")
            create_file(spark, mark, "")
