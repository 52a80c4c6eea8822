"""Session settings and the shared folder for intermediate tables."""

import re
import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

# Settings this engine counts on. Shuffle width is left to the cluster.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Account ids such as 000000000001 must stay text.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # Log files are small and compressed: pack many into one task.
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.files.openCostInBytes": "1m",
    # State of the streaming dedup outgrows the heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, named by spark.checkpoint.dir.

    Only where driver and executors are one process may it be unset.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        named = tempfile.mkdtemp(prefix="auditlake-")
        spark.conf.set("spark.checkpoint.dir", named)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(named)
    return named


def scratch(spark: SparkSession, label: str) -> str:
    """A new, unused folder name below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/auditlake-{label}-{uuid.uuid4().hex[:12]}"


LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
#: Tasks that list files, for each core.
LISTERS = 4


def list_in_few_tasks(spark: SparkSession) -> None:
    """From now on the session lists files by a few tasks a core, or by fewer if it is set so.

    Spark asks for each of up to 10,000 given paths in a task of its own, whose status alone is thousands of
    bytes for the driver. A stream lists with its session's settings of the moment, so they are not set back.
    """
    most = LISTERS * max(spark.sparkContext.defaultParallelism, 1)
    if int(spark.conf.get(LISTING_TASKS)) > most:
        spark.conf.set(LISTING_TASKS, most)


#: What opening a file counts as while a run is made, in bytes, if the session has Spark's own value.
OPEN_COST_KEY, DEFAULT_OPEN_COST, OPEN_COST = "spark.sql.files.openCostInBytes", 4 * 1024 * 1024, 1024 * 1024


@contextmanager
def small_files(spark: SparkSession):
    """In this block up to 128 small files are the work of one task, not 32; as many tasks as cores stay."""
    if spark.conf.get(OPEN_COST_KEY) not in (str(DEFAULT_OPEN_COST), f"{DEFAULT_OPEN_COST}b"):
        yield
        return
    with _changed(spark, {OPEN_COST_KEY: str(OPEN_COST)}):
        yield


@contextmanager
def _changed(spark: SparkSession, settings: dict[str, str]):
    """The session has these settings in this block, and what it had before behind it."""
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


#: Hadoop's file systems of local paths write a file of checksums beside each file and, without its native
#: library, start a `chmod` for either: dearer than all else about a small file. These know no checksums.
LOCAL_CHECKPOINTS = {"fs.AbstractFileSystem.file.impl": "org.apache.hadoop.fs.local.RawLocalFs"}
LOCAL_FILES = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}
STATE_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
#: A run's folder counts by its commit, not by a mark in it.
RUN_FOLDERS = {"mapreduce.fileoutputcommitter.marksuccessfuljobs": "false"}


def _unless_set(spark: SparkSession, settings: dict[str, str]) -> dict[str, str]:
    return {} if any(spark.conf.get(f"{p}{k}", None) is not None for k in settings for p in ("", "spark.hadoop.")) else settings


@contextmanager
def plain_local_files(spark: SparkSession):
    """Local files written in this block have no checksum files beside them, unless the session names a file
    system for local paths itself. Other stores are not touched."""
    with _changed(spark, _unless_set(spark, LOCAL_FILES)):
        yield


@contextmanager
def plain_local_stream(spark: SparkSession, stateful: bool = False):
    """As `plain_local_files`, of a stream that starts in this block and of its checkpoint folder.

    RocksDB, if it keeps the state, copies through the file system with checksums and takes no other.
    """
    files = {} if stateful and "RocksDB" in spark.conf.get(STATE_PROVIDER) else _unless_set(spark, LOCAL_FILES)
    with _changed(spark, _unless_set(spark, LOCAL_CHECKPOINTS) | files):
        yield


@contextmanager
def run_folders(spark: SparkSession):
    """For writing folders that only count once a commit names them, as those of runs and merges."""
    with plain_local_files(spark), _changed(spark, _unless_set(spark, RUN_FOLDERS)):
        yield


#: Parts of a stream's state: for each core, and at least, as a stream that has begun keeps their number.
STATE_PARTS, LEAST_STATE_PARTS = 1, 8
SHUFFLE_PARTS, DEFAULT_PARTS = "spark.sql.shuffle.partitions", "200"


@contextmanager
def state_width(spark: SparkSession):
    """A stream started in this block gets parts of its state by the number of cores, unless the session has
    another shuffle width than Spark's own.

    Each part writes some files of its own at every trigger, however few rows it gets. A stream takes its
    settings over when it starts, and its checkpoint folder keeps the width.
    """
    parts = max(STATE_PARTS * spark.sparkContext.defaultParallelism, LEAST_STATE_PARTS)
    with _narrowed(spark, parts):
        yield


LEAF_PARTS, FILE_PARTS = "spark.sql.leafNodeDefaultParallelism", "spark.sql.files.minPartitionNum"


@contextmanager
def few_rows(spark: SparkSession):
    """Shuffles in this block have as many parts as cores, unless the session has another width than Spark's own:
    a task that deals a few rows to 200 parts opens 200 files. The driver's own rows are the work of one task;
    files are dealt to as many as before."""
    cores = max(spark.sparkContext.defaultParallelism, 1)
    own = {LEAF_PARTS: "1", FILE_PARTS: str(cores)}
    with _narrowed(spark, cores), _changed(spark, _unless_set(spark, own)):
        yield


@contextmanager
def _narrowed(spark: SparkSession, parts: int):
    if spark.conf.get(SHUFFLE_PARTS) != DEFAULT_PARTS or parts >= int(DEFAULT_PARTS):
        yield
        return
    with _changed(spark, {SHUFFLE_PARTS: str(parts)}):
        yield


def java_paths(spark: SparkSession, paths: list[str]):
    """Paths for a reader of the JVM, sent as one text: a list goes there one path at a time."""
    return spark._jvm.org.apache.commons.lang3.StringUtils.split("\0".join(paths), "\0")


def at_once(spark: SparkSession, *steps: Callable[[], object]) -> list:
    """Do steps that need nothing of each other at the same time, in the caller's job group; what they gave.

    All have ended before a failure of one is raised.
    """
    with ThreadPoolExecutor(len(steps)) as pool:
        begun = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
    return [b.result() for b in begun]


def stored(df: DataFrame, path: str) -> DataFrame:
    """A table as it was written down at `path`, whose columns need not be found out from the files."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def file_system(spark: SparkSession, path: str):
    """The file system of a path, and the path as an object of it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def create_file(spark: SparkSession, path: str, text: str) -> bool:
    """Make a small file that is not there yet; false if it is. Only one of several writers makes it,
    on stores that create files exclusively."""
    fs, target = file_system(spark, path)
    try:
        out = fs.create(target, False)
    except Py4JJavaError:
        if not fs.exists(target):
            raise
        return False
    out.write(bytearray(text.encode()))
    out.close()
    return True


def read_file(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, None if it is not there."""
    fs, target = file_system(spark, path)
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def folders_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; none if it is not there."""
    fs, target = file_system(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(target) if s.isDirectory()] if fs.exists(target) else []


def drop_folder(spark: SparkSession, path: str) -> None:
    fs, target = file_system(spark, path)
    fs.delete(target, True)


@contextmanager
def scratch_folder(spark: SparkSession, label: str):
    """A scratch folder that goes when the block ends, however it ends."""
    path = scratch(spark, label)
    try:
        yield path
    finally:
        drop_folder(spark, path)
