"""Writers of the state tables, one `run_id=...` folder per run.

A run's folders are its own; no other run writes into them.
"""

import json
import threading
import time
import uuid
from contextlib import contextmanager, nullcontext

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import BLOOM, CHECKPOINT, FAILED_FILE, METRICS, SEEN
from ..session import create_file, drop_folder, few_rows, file_system, folders_in, read_file
from ..sources.known_ids import PAGE_IDS, id_hash, id_slot, layer_of
from ..sources.tables import commit_file, committed_runs, seen_segments, segment_id, table_path

#: A merged folder is merged again once what came after it has this part of its ids.
MERGE_SHARE = 0.5
#: Ids whose merging costs what its steps cost.
FEW_IDS = 1_000_000
#: Tables of a run, to be dropped if it fails.
RUN_TABLES = ("events", "manifest", "seen", "bloom", "checkpoints", "failed_files", "metrics", "replaced")


def write_seen(seen: DataFrame, root: str, run_id: str, slots: int = 16) -> None:
    """Append a run's ids in order of their hash, in folders by ranges of it."""
    _write_ids(seen, table_path(root, "seen", run_id), slots)


def _write_ids(ids: DataFrame, path: str, slots: int) -> None:
    hashed = ids.select("event_id", "event_date", id_hash("event_id").alias("id_hash"))
    writer = (hashed.withColumn("id_slot", id_slot(F.col("id_hash"), slots))
              .repartitionByRange("id_hash").sortWithinPartitions("id_slot", "id_hash").write.mode("overwrite"))
    # Small pages, whose statistics are read first; no dictionary of values that hardly repeat.
    for name, value in (("parquet.page.row.count.limit", PAGE_IDS), ("parquet.enable.dictionary#event_id", "false"),
                        ("parquet.enable.dictionary#id_hash", "false"),
                        ("parquet.columnindex.truncate.length", 8)):
        writer = writer.option(name, str(value))
    writer.partitionBy("id_slot").parquet(f"{path}/id_slots={slots}")


def compact_seen(spark: SparkSession, root: str, slots: int = 16, layer: tuple[int, float] | None = None) -> None:
    """Merge the ids of the last runs into one folder, and older merged folders while they are not
    much larger: each id is written again a few times only, however long the history.

    With `layer`, the items and the error rate of sketches, the merged ids get a sketch of their own.
    A merged folder counts once its mark is written. What it was made from stays until the next call, as
    readers may be at it. To be called by the writer that holds the claim.
    """
    runs = [r for _, r in committed_runs(spark, root)]
    segments, behind = seen_segments(spark, root, runs)
    if not behind:
        return
    _drop_unused(spark, root, {segment_id(a, b) for a, b, _ in segments}, set(behind))
    sources = [table_path(root, "seen", r) for r in behind]
    read = spark.read.schema(SEEN)

    def ids(paths):
        parts = [read.option("basePath", path).parquet(path) for path in paths]
        found = parts[0]
        for p in parts[1:]:
            found = found.unionByName(p)
        return found.select("event_id", "event_date")

    size, first = ids(sources).count(), behind[0]
    while segments and size >= MERGE_SHARE * segments[-1][2]:
        first, last, more = segments.pop()
        sources.append(table_path(root, "seen_base", segment_id(first, last)))
        size += more
    made = segment_id(first, behind[-1])
    with few_rows(spark) if size <= FEW_IDS else nullcontext():
        _write_ids(ids(sources), table_path(root, "seen_base", made), slots)
        if layer is not None:
            # Of what was just written, which lies in fewer files.
            merged = table_path(root, "seen_base", made)
            write_layer(layer_of(ids([merged]), size, *layer), root, made, "bloom_base")
    (spark.range(1).select(F.lit(first).alias("first"), F.lit(size).cast("bigint").alias("ids"),
                           F.lit(behind[-1]).alias("run_id")).coalesce(1)
     .write.mode("overwrite").json(table_path(root, "seen_base_done") + f"/made={made}"))


def _drop_unused(spark: SparkSession, root: str, segments: set[str], runs: set[str]) -> None:
    """Ids and sketches that an earlier call merged, or that a failed run left."""
    for table, used in (("seen", runs), ("bloom", runs), ("seen_base", segments), ("bloom_base", segments)):
        for name in folders_in(spark, table_path(root, table)):
            if name.removeprefix("run_id=") not in used:
                drop_folder(spark, f"{table_path(root, table)}/{name}")


def drop_run(spark: SparkSession, root: str, run_id: str) -> None:
    """What a run that failed has written."""
    for table in RUN_TABLES:
        drop_folder(spark, table_path(root, table, run_id))


class Claimed(RuntimeError):
    """Another run has the number."""


class Lease:
    """The right to make one run (or one merge), by a file that holds a token of its own."""

    def __init__(self, spark: SparkSession, root: str, seq: int, kind: str = ""):
        self.spark, self.root, self.seq = spark, root, seq
        self.path, self.token = f"{table_path(root, f'{kind}claims')}/{seq:08d}", uuid.uuid4().hex
        self.file = commit_file(root, seq, kind)

    def held(self) -> bool:
        return read_file(self.spark, self.path) == self.token

    def take(self, hours: float) -> None:
        fs, at = file_system(self.spark, self.path)
        if fs.exists(at) and time.time() - fs.getFileStatus(at).getModificationTime() / 1000 > hours * 3600:
            fs.delete(at, False)
        if not create_file(self.spark, self.path, self.token):
            raise Claimed(f"run {self.seq} of {self.root} is being made by another writer, or died within {hours} hours")

    def renew(self) -> None:
        """Write the file once more; not every store can set a file's time."""
        if self.held():
            fs, at = file_system(self.spark, self.path)
            out = fs.create(at, True)
            out.write(bytearray(self.token.encode()))
            out.close()

    def drop(self) -> None:
        if self.held():
            fs, at = file_system(self.spark, self.path)
            fs.delete(at, False)

    def commit(self, run_id: str) -> None:
        """Make the run count. Of two writers that both think to hold the number, one can."""
        if not self.held():
            raise Claimed(f"run {self.seq} of {self.root} was taken over by another writer")
        if not create_file(self.spark, self.file, json.dumps({"seq": self.seq, "run_id": run_id}) + "\n"):
            raise Claimed(f"run {self.seq} of {self.root} was committed by another writer")


@contextmanager
def claimed(spark: SparkSession, root: str, seq: int, hours: float, kind: str = ""):
    """Hold run number `seq` while the block runs; its lease is renewed four times within `hours`.

    A claim that was not renewed for `hours` was left behind by a run that died, and is taken over.
    """
    lease, ended = Lease(spark, root, seq, kind), threading.Event()
    lease.take(hours)

    def renewing():
        while not ended.wait(max(hours * 900, 1)):
            lease.renew()

    thread = threading.Thread(target=renewing, daemon=True)
    thread.start()
    try:
        yield lease
    finally:
        ended.set()
        thread.join()
        lease.drop()


def write_checkpoints(checkpoints: DataFrame, root: str, run_id: str) -> None:
    checkpoints.select(*CHECKPOINT.names).write.mode("overwrite").parquet(table_path(root, "checkpoints", run_id))


def write_failed_files(failed: DataFrame, root: str, run_id: str) -> None:
    failed.select(*FAILED_FILE.names).write.mode("overwrite").parquet(table_path(root, "failed_files", run_id))


def write_layer(layer: DataFrame, root: str, name: str, table: str = "bloom") -> None:
    columns = [c for c in BLOOM.names if c != "run_id"]
    layer.select(*columns).write.mode("overwrite").parquet(table_path(root, table, name))


def write_metrics(metrics: DataFrame, root: str, run_id: str) -> None:
    """One JSON line."""
    columns = [c for c in METRICS.names if c != "run_id"]
    metrics.select(*columns).coalesce(1).write.mode("overwrite").json(table_path(root, "metrics", run_id))
