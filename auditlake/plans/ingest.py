"""One incremental run: new objects in, new events out.

    pending objects -> scan -> narrow rows, without the text
    narrow rows     -> one group per id, reject reason and file -> known ids marked
                    -> copies that lose, as a bitmap for each file
    scan again      -> files with their bitmaps -> records without the losers -> events
    groups          -> lines written compared -> seen ids, checkpoints, failed files, metrics -> commit

So the text is moved once, by the sink. All counts come from tables that were written down, so a
repeated task cannot count twice.
"""

import math
import time
import uuid
from collections.abc import Iterable
from contextlib import nullcontext

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..functions.naming import add_rates
from ..functions.paths import bare_path, glob_literal
from ..operators import losers as lose
from ..operators.checkpoints import advance_checkpoints, merge_checkpoints, pending_objects
from ..operators.discovery import log_objects
from ..operators.metrics import run_metrics
from ..operators.numbering import running_number
from ..operators.records import classify_records
from ..options import IngestOptions, Trail
from ..schemas import FAILED_FILE, PAIR
from ..session import at_once, few_rows, run_folders, scratch_folder, small_files, stored
from ..sinks import (claimed, compact_seen, drop_run, write_checkpoints, write_events, write_failed_files, write_layer,
                     write_manifest, write_metrics, write_seen)
from ..sinks.events import Written
from ..sources.known_ids import Layer, known_among, known_layers, layer_of, probe_layers
from ..sources.listing import distinct_objects, list_objects
from ..sources.log_files import explode_records, read_log_files
from ..sources.tables import (IdFolders, committed_runs, later_runs, read_checkpoints, read_failed_files, read_metrics,
                              seen_segments, table_path)
from .progress import RunProgress, run_progress

# First character of a group's id: what the group stands for.
EVENT, UNNAMED, REJECT, FILE = "e", "u", "r", "f"
PLANNED = StructType([*FAILED_FILE.fields, StructField("run_no", IntegerType())])
#: Between a run's id and the token of the attempt that makes it.
ATTEMPT = "~"
#: A run of so few files and bytes costs what its steps cost: its list of files stays with the driver.
FEW_FILES, FEW_BYTES = 1_000, 64 * 1024 * 1024


def plan_runs(pending: DataFrame, max_files: int, path: str) -> int:
    """Write `pending` below `path`, split into runs of at most `max_files`; how many.

    First keys first, so that no run leaves a gap in a pair. The listing is taken
    once; only if it is too large for one run is it sorted and numbered.
    """
    spark = pending.sparkSession
    pending.withColumn("run_no", F.lit(0)).write.partitionBy("run_no").parquet(f"{path}/all")
    found = spark.read.schema(PLANNED).parquet(f"{path}/all")
    total = found.count()
    if total <= max_files:
        return min(total, 1)
    (found.drop("run_no").repartitionByRange("bucket", "key")
     .withColumn("_slot", F.spark_partition_id()).write.parquet(f"{path}/sorted"))
    numbered = running_number(spark.read.parquet(f"{path}/sorted"), [], ["_slot"], ["bucket", "key"])
    run_no = F.floor((F.col("_number") - 1) / max_files).cast("int")
    (numbered.withColumn("run_no", run_no).drop("_number", "_slot").hint("rebalance", "run_no")
     .write.partitionBy("run_no").parquet(f"{path}/runs"))
    return math.ceil(total / max_files)


def numbered_files(files: DataFrame) -> DataFrame:
    """The files of one run, at most `max_files` rows, with `file_no` in order of arrival."""
    order = Window.orderBy("trail_rank", "key", "bucket")
    return files.withColumn("file_no", F.row_number().over(order).cast("bigint"))


def taken(files: DataFrame, most: int, path: str) -> tuple[DataFrame, int, int]:
    """The `numbered_files` of a run, seldom more than `most`, as all its steps see them, their number and their bytes.

    Few files are a table of the driver's; more are written down at `path`.
    """
    spark, numbered = files.sparkSession, numbered_files(files)
    few = numbered.limit(FEW_FILES + 1).toArrow() if most <= FEW_FILES else None
    if few is None or few.num_rows > FEW_FILES:
        files = stored(numbered, path)
        count, size = files.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
        if count > FEW_FILES:
            return files, count, size
        few = files.orderBy("file_no").toArrow()
    return spark.createDataFrame(few, numbered.schema), few.num_rows, sum(x or 0 for x in few["size"].to_pylist())


def opened(spark: SparkSession, files: DataFrame) -> DataFrame:
    """(_at, Records, _corrupt) of the files of one run, at most `max_files`: their paths go to the reader."""
    paths = [r.path for r in files.select(glob_literal("path").alias("path")).collect()]
    if paths:
        return read_log_files(spark, paths).select(bare_path("path").alias("_at"), "Records", "_corrupt")
    return spark.createDataFrame([], "_at string, Records array<string>, _corrupt string")


def _with_columns(read: DataFrame, files: DataFrame, *columns: str) -> DataFrame:
    """The opened files that are among `files`, with `columns` of theirs."""
    return read.join(F.broadcast(files.select(bare_path("path").alias("_at"), *columns)), "_at").drop("_at")


def scan_records(read: DataFrame, files: DataFrame) -> DataFrame:
    """Records of opened files, and a row of ordinal -1 for each file.

    `place` orders the records by file and ordinal.
    """
    place = (F.shiftleft("file_no", 32) + F.col("ordinal")).alias("place")
    rows = explode_records(_with_columns(read, files, "file_no", "bucket", "key"), file_rows=True)
    return rows.select("file_no", "bucket", "key", "ordinal", place, "raw", "_corrupt")


def narrow_rows(records: DataFrame, options: IngestOptions) -> DataFrame:
    """`(group_id, place, day, corrupt)` of each record and file; the text stays behind.

    Records with one event id are a group, and so are those with one reject reason; a file is a
    group of its own. `day` counts from 1970.
    """
    c = classify_records(records, options.strict)
    is_file = F.col("ordinal") < 0
    file_id = F.concat_ws("/", F.lit(FILE), "bucket", "key")
    event = F.concat(F.lit(EVENT), F.col("event_id"))
    if options.keep_missing_ids:
        event = F.when(F.col("event_id") == "", F.concat_ws("/", F.lit(UNNAMED), "place")).otherwise(event)
    group = (F.when(is_file, file_id)
             .when(F.col("reject_reason").isNotNull(), F.concat(F.lit(REJECT), F.col("reject_reason")))
             .otherwise(event))
    # Of the clock the record shows, as its folder is.
    day = F.datediff(F.concat_ws("-", "year", "month", "day").try_cast("date"), F.lit("1970-01-01"))
    kept = ~is_file & F.col("reject_reason").isNull()
    return c.select(group.alias("group_id"), "place", F.when(kept, day).alias("day"),
                    F.col("_corrupt").isNotNull().alias("corrupt"))


def group_rows(rows: DataFrame) -> DataFrame:
    """One row per group of `narrow_rows` with its first place, from one shuffle of fixed-width sums.

    Each id, reject reason and file is combined before the shuffle.
    """
    kind = F.substring("group_id", 1, 1)
    date = F.date_add(F.lit("1970-01-01"), F.col("day")).cast("string")
    return (rows.groupBy("group_id")
            .agg(F.min("place").alias("place"), F.count(F.lit(1)).alias("copies"), F.min("day").alias("day"),
                 F.max(F.col("corrupt").cast("int")).alias("corrupt"))
            .select("group_id", kind.alias("kind"), "place", "copies", (F.col("corrupt") > 0).alias("corrupt"),
                    F.when(kind == EVENT, F.substr("group_id", F.lit(2))).alias("event_id"),
                    F.when(kind == REJECT, F.substr("group_id", F.lit(2))).alias("reject_reason"),
                    F.coalesce(date, F.lit("")).alias("event_date")))


def losing_records(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """(file_no, ordinal) of good records that are not written: later copies, and copies of known events."""
    several = groups.filter((F.col("kind") == EVENT) & ((F.col("copies") > 1) | F.col("is_seen"))).select(
        "group_id", F.col("place").alias("_first"), "is_seen")
    return (rows.select("group_id", "place").join(several, "group_id")
            .filter(F.col("is_seen") | (F.col("place") != F.col("_first")))
            .select(F.shiftright("place", 32).alias("file_no"),
                    F.col("place").bitwiseAND(F.lit(2 ** 32 - 1)).alias("ordinal")))


def new_events(read: DataFrame, files: DataFrame, losers: DataFrame, options: IngestOptions) -> DataFrame:
    """The good records of opened `files` that are written.

    `losers` are `loser_bitmaps`: each comes with its file, whose records are exploded without the
    losers, so that the text is neither joined nor shuffled here.
    """
    marked = files.join(losers.select("file_no", "losers"), "file_no", "left")
    read = _with_columns(read, marked, "losers")
    left = read.withColumn("Records", lose.without_losers(F.col("Records"), F.col("losers"))).drop("losers")
    return classify_records(explode_records(left), options.strict).filter(F.col("reject_reason").isNull())


def _maybe_seen(groups: DataFrame, layers: list[Layer] | None, options: IngestOptions) -> DataFrame:
    """Add `maybe_seen`: false for what needs no comparison with the ids written before."""
    is_event = F.col("kind") == EVENT
    if layers is None:
        return groups.withColumn("maybe_seen", is_event)
    return probe_layers(groups, layers, options.bloom_fpp).withColumn("maybe_seen", F.col("maybe_seen") & is_event)


def _mark_seen(staged: DataFrame, root, runs, options: IngestOptions, ids: int | None = None,
               folders: IdFolders | None = None) -> DataFrame:
    """Add `is_seen`, by comparing the groups that a sketch may hold with the ids themselves, `ids` of them.

    Without such groups no id is read. Groups are unique, so no id is hot any more.
    """
    spark = staged.sparkSession
    keys = ["event_id", "event_date"] if options.prune_by_date else ["event_id"]
    hits = staged.filter("maybe_seen").select("event_id", "event_date")
    if not runs or hits.isEmpty():
        return staged.drop("maybe_seen").withColumn("is_seen", F.lit(False))
    known = known_among(spark, root, runs, hits, keys, ids=ids, folders=folders).withColumn("_known", F.lit(True))
    compared = staged.filter("maybe_seen").join(known, keys, "left")
    rest = staged.filter("not maybe_seen").withColumn("is_seen", F.lit(False))
    return rest.unionByName(compared.withColumn("is_seen", F.col("_known").isNotNull()).drop("_known")).drop("maybe_seen")


def ingest_objects(spark: SparkSession, files: DataFrame, root: str, run_id: str,
                   options: IngestOptions) -> DataFrame:
    """Read the listed files and commit their new events as one run.

    `files` are rows of `log_objects` with `attempts`, few enough for one run. A
    committed run id is not run again. Gives the run's metrics.
    """
    done = commit_run(spark, files, root, run_id, options, committed_runs(spark, root))
    return add_rates(read_metrics(spark, root).filter(F.col("run_id") == done))


def commit_run(spark: SparkSession, files: DataFrame, root: str, run_id: str, options: IngestOptions,
               runs: list[tuple[int, str]]) -> str:
    """As `ingest_objects`, behind the committed `runs`; the id of the attempt that was committed."""
    done = next((r for _, r in runs if r.split(ATTEMPT)[0] == run_id), None)
    if done is None:
        seq = runs[-1][0] + 1 if runs else 1
        # An attempt writes into folders of its own: one that was taken for dead spoils no other.
        done = f"{run_id}{ATTEMPT}{uuid.uuid4().hex[:8]}"
        with claimed(spark, root, seq, options.claim_hours) as lease:
            try:
                with run_progress(spark, done, options.progress_seconds) as progress, scratch_folder(spark, "ingest") as work, small_files(spark), run_folders(spark):
                    full = _write_run(spark, files, root, done, seq, [r for _, r in runs], options, work, progress)
                lease.commit(done)
            except BaseException:
                drop_run(spark, root, done)
                raise
            if seq % options.compact_every == 0 or full:
                with run_folders(spark), small_files(spark):
                    compact_seen(spark, root, options.id_buckets,
                                 (options.bloom_items, options.bloom_fpp) if options.dedup == "approx" else None)
    return done


def _write_run(spark, files: DataFrame, root: str, run_id: str, seq: int, run_ids: list[str],
               options: IngestOptions, work: str, progress: RunProgress) -> bool:
    """All tables of a run; whether the sketches or the folders of ids have become too many."""
    started = time.time()
    # Taken once, so that all steps see one listing.
    files, count, size = taken(files, options.max_files, f"{work}/files")
    progress.step("scan", files=count, bytes=size)
    with few_rows(spark) if count <= FEW_FILES and size <= FEW_BYTES else nullcontext():
        return _write_files(spark, files, count, root, run_id, seq, run_ids, options, work, progress, started)


def _write_files(spark, files: DataFrame, count: int, root: str, run_id: str, seq: int, run_ids: list[str],
                 options: IngestOptions, work: str, progress: RunProgress, started: float) -> bool:
    approx = options.dedup == "approx"
    read = opened(spark, files)

    def history() -> tuple[IdFolders, list[Layer] | None]:
        folders = seen_segments(spark, root, run_ids)
        return folders, known_layers(spark, root, run_ids, options.bloom_items, options.bloom_fpp, folders) if approx else None

    # A run of few files takes as long as its steps take one after another, so what can goes side by side.
    (folders, layers), rows = at_once(
        spark, history, lambda: stored(narrow_rows(scan_records(read, files), options), f"{work}/rows"))
    progress.step("dedup")
    groups = stored(_maybe_seen(group_rows(rows), layers, options), f"{work}/groups")
    known = None if layers is None else sum(x.added for x in layers)
    groups = stored(_mark_seen(groups, root, run_ids, options, known, folders), f"{work}/marked")

    is_new = ~F.col("is_seen")
    (losers, ranges), tried, source, (wanted, named) = at_once(
        spark,
        lambda: _losers(files, rows, groups, work),
        lambda: _tried(files, count, groups),
        lambda: _text_files(files, count, groups, work),
        lambda: groups.agg(F.count_if(F.col("kind").isin(EVENT, UNNAMED) & is_new), F.count_if((F.col("kind") == EVENT) & is_new)).first())
    progress.step("write", events=wanted)
    ids = groups.filter((F.col("kind") == EVENT) & is_new)
    written, counted, *_ = at_once(
        spark,
        lambda: _write_text(spark, source, read if source is files else None, losers, ranges, root, run_id, wanted, options),
        # A file's own group is no event. What the sink wrote is not known yet.
        lambda: run_metrics(groups.filter(F.col("kind") != FILE), tried, 0, 0).toArrow(),
        lambda: write_seen(ids, root, run_id, options.id_buckets),
        lambda: write_layer(layer_of(ids, named, options.bloom_items, options.bloom_fpp), root, run_id) if approx else None,
        lambda: write_checkpoints(_advanced(spark, root, run_ids, tried, options), root, run_id),
        lambda: _write_failed(spark, tried, root, run_id, run_ids, options))

    progress.step("state")
    metrics = spark.createDataFrame(counted).withColumns({
        "jsonl_files": F.lit(written.files).cast("bigint"), "hour_buffers": F.lit(written.folders).cast("bigint"),
        "seq": F.lit(seq).cast("bigint"), "finished_at": F.current_timestamp(), "elapsed_seconds": F.lit(time.time() - started)})
    write_metrics(metrics, root, run_id)
    return len(layers or []) > options.most_sketches or (len(folders[1]) + 1) * options.id_buckets > options.most_id_folders


def _tried(files: DataFrame, count: int, groups: DataFrame) -> DataFrame:
    """The `count` files of a run, and whether they were `downloaded` and `failed`; few stay with the driver."""
    found = groups.filter(F.col("kind") == FILE).select((F.shiftright("place", 32) + 1).alias("file_no"), "corrupt")
    if count <= FEW_FILES:
        found = files.sparkSession.createDataFrame(found.toArrow(), found.schema)
    return (files.join(found, "file_no", "left")
            .withColumn("downloaded", F.col("corrupt").isNotNull())
            .withColumn("failed", F.coalesce("corrupt", F.lit(True))).drop("corrupt"))


def _text_files(files: DataFrame, count: int, groups: DataFrame, work: str) -> DataFrame:
    """Those of `count` files that hold an event to be written; `files` itself if these are more than half of them,
    as files named anew are listed anew."""
    new = groups.filter(F.col("kind").isin(EVENT, UNNAMED) & ~F.col("is_seen"))
    first = new.select(F.shiftright("place", 32).alias("file_no")).distinct()
    if count <= FEW_FILES:
        table = first.toArrow()
        first, found = files.sparkSession.createDataFrame(table, first.schema), table.num_rows
    else:
        first = stored(first, f"{work}/first")
        found = first.count()
    return files.join(F.broadcast(first), "file_no", "left_semi") if 2 * found <= count else files


def _losers(files: DataFrame, rows: DataFrame, groups: DataFrame, work: str) -> tuple[DataFrame, list[tuple[int, int]]]:
    """The bitmaps of the copies that lose, and the ranges of files whose bitmaps may be broadcast together."""
    losers = stored(lose.loser_bitmaps(losing_records(rows, groups)), f"{work}/losers")
    return losers, lose.scan_ranges(files, losers)


def _write_text(spark, files: DataFrame, read: DataFrame | None, losers: DataFrame, ranges: list[tuple[int, int]], root: str,
                run_id: str, wanted: int, options: IngestOptions) -> Written:
    """The events of a run, `wanted` of them, and their manifest.

    Files with new events are read a second time (as `read`, if all are), now for their text, which goes
    straight to the sink. Only a run with more losers than may be broadcast does so in several steps.
    """
    events = table_path(root, "events", run_id)
    for i, (first, last) in enumerate(ranges or [(0, 0)]):
        part = files.filter(F.col("file_no").between(first, last))
        new = new_events(read if read is not None and len(ranges) < 2 else opened(spark, part), part, losers, options)
        write_events(new, events, options.events_per_file, "append" if i else "overwrite", wanted)
    # A file that the second scan cannot read, or only in part, gives fewer lines and no error.
    written = write_manifest(spark, root, run_id)
    if written.rows != wanted:
        raise RuntimeError(f"run {run_id} wrote {written.rows} of {wanted} events: a file could not be read again")
    return written


def _write_failed(spark, tried: DataFrame, root: str, run_id: str, run_ids: list[str], options: IngestOptions) -> None:
    wait = F.least(F.lit(86_400.0), options.retry_seconds * F.pow(F.lit(2.0), F.least("attempts", F.lit(40))))
    retry_at = F.current_timestamp() + F.make_dt_interval(secs=wait.cast("decimal(18,6)"))
    failed = (tried.filter("failed").withColumn("retry_at", retry_at)
              .withColumn("attempts", F.col("attempts") + 1).select(*FAILED_FILE.names))
    before = read_failed_files(spark, root, run_ids)
    waiting = before.join(tried.select("bucket", "key"), ["bucket", "key"], "left_anti")
    write_failed_files(waiting.select(*FAILED_FILE.names).unionByName(failed), root, run_id)


def due_files(spark, root: str, run_ids: list[str], options: IngestOptions) -> DataFrame:
    """Files that could not be read and whose time to be tried again has come."""
    failed = read_failed_files(spark, root, run_ids).filter(F.col("retry_at") <= F.current_timestamp())
    return failed if options.give_up_after is None else failed.filter(F.col("attempts") < options.give_up_after)


def requeue_files(spark: SparkSession, root: str, which: Column | None = None) -> int:
    """Make files that could not be read, given-up ones too, due at once; how many.

    `which` is a condition on the failed files; without it all are meant.
    """
    runs = [r for _, r in committed_runs(spark, root)]
    if not runs:
        return 0
    which = F.lit(True) if which is None else F.coalesce(which, F.lit(False))
    with scratch_folder(spark, "requeue") as work:
        read_failed_files(spark, root, runs).write.parquet(work)
        failed = spark.read.schema(FAILED_FILE).parquet(work)
        again = F.when(which, F.lit(0).cast("timestamp"))
        write_failed_files(failed.withColumns({
            "attempts": F.when(which, F.lit(1)).otherwise(F.col("attempts")).cast("bigint"),
            "retry_at": F.coalesce(again, "retry_at")}), root, runs[-1])
        return failed.filter(which).count()


def _advanced(spark, root, run_ids, tried: DataFrame, options: IngestOptions) -> DataFrame:
    """Old checkpoints plus this run's files; files that failed do not count as processed."""
    read = tried.filter(~F.col("failed")).groupBy(*PAIR).agg(F.count(F.lit(1)).alias("_read"))
    fresh = (advance_checkpoints(tried, options.checkpoint_every).join(read, PAIR, "left")
             .withColumn("files_processed", F.coalesce("_read", F.lit(0))).drop("_read"))
    return merge_checkpoints(read_checkpoints(spark, root, run_ids), fresh)


def ingest_batch(spark: SparkSession, trails: Iterable[Trail], root: str,
                 options: IngestOptions = IngestOptions(), objects: DataFrame | None = None) -> DataFrame:
    """Ingest what is new below the trails into the tables under `root`.

    All pending files are taken, in runs of at most `max_files` that commit one by
    one; after a failure the next call goes on behind the last committed run.
    `objects` may be an inventory table in place of a listing. Gives the metrics of
    the runs made.
    """
    runs = committed_runs(spark, root)
    run_ids = [r for _, r in runs]
    seq = runs[-1][0] + 1 if runs else 1
    checkpoints = read_checkpoints(spark, root, run_ids)
    made = []
    with scratch_folder(spark, "plan") as work, small_files(spark), run_folders(spark):
        listed = objects
        if listed is None:
            listed = list_objects(spark, trails, options, after=checkpoints, path=f"{work}/listing")
        listed = log_objects(distinct_objects(listed), options.strict_accounts)
        pending = (pending_objects(listed, checkpoints)
                   .withColumns({"attempts": F.lit(0).cast("bigint"), "retry_at": F.lit(None).cast("timestamp")})
                   .select(*FAILED_FILE.names)
                   .unionByName(due_files(spark, root, run_ids, options).select(*FAILED_FILE.names)))
        count = plan_runs(pending, options.max_files, work)
        for i in range(count):
            part = f"{work}/all/run_no=0" if count == 1 else f"{work}/runs/run_no={i}"
            files = spark.read.schema(FAILED_FILE).parquet(part)
            made.append(f"{seq + i:08d}-{uuid.uuid4().hex[:8]}")
            runs = later_runs(spark, root, runs)
            commit_run(spark, files, root, made[-1], options, runs)
    return add_rates(read_metrics(spark, root).filter(F.substring_index("run_id", ATTEMPT, 1).isin(made)))
