"""Trails and the listing of their objects.

The folders above the files are walked first, and only what can hold new log files is listed: the
trail folders of account and region pairs, and of a pair that was read before only the folders
that do not end before its last read key. The walk goes down to the folders that hold files (or `LEVELS`
below a region) and hands them on in chunks; Spark lists one chunk after another and writes the keys
down, so that the driver never holds more than those of one chunk.
"""

from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from itertools import chain

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.paths import LOGS_FOLDER, TRAIL_FOLDER, glob_escaped, object_key
from ..options import IngestOptions, Trail
from ..schemas import LOG_SUFFIX, OBJECT, TRAIL
from ..session import file_system, scratch, small_files
from .paths import load_or_empty

#: Folders asked for at the same time.
THREADS = 16
#: Folder levels below a region that are looked into.
LEVELS = 8
#: Pairs whose folders are walked at the same time.
PAIRS = 64
#: Files of one listing, after which no further folder is added to it: the driver holds some 2 KB of each.
LIST_FILES = 20_000


def as_trails(trails: Iterable[Trail] | DataFrame) -> list[Trail]:
    """The trails in order of rank. A table has `name`, `bucket`, `prefix`, and may have `trail_rank`,
    without which names are in order; it is as small as a list of trails."""
    if not isinstance(trails, DataFrame):
        return [Trail(*t) for t in trails]
    order = ["trail_rank"] if "trail_rank" in trails.columns else []
    rows = trails.orderBy(*order, "name", "bucket", "prefix").collect()
    return [Trail(r.name, r.bucket, r.prefix or "") for r in rows]


def trails_df(spark: SparkSession, trails: Iterable[Trail] | DataFrame) -> DataFrame:
    """The trail list as a table; its order ranks trails for dedup."""
    rows = [(t.name, t.bucket, t.prefix or "", i) for i, t in enumerate(as_trails(trails))]
    return spark.createDataFrame(rows, TRAIL)


def bucket_root(bucket: str, options: IngestOptions) -> str:
    return options.bucket_uri.format(bucket=bucket).rstrip("/")


def trail_root(trail: Trail, options: IngestOptions) -> str:
    prefix = f"{trail.prefix}/" if trail.prefix else ""
    return f"{bucket_root(trail.bucket, options)}/{prefix}{LOGS_FOLDER}"


class Walk:
    """The folders of one trail that a listing has to read; `asked` are those that were looked into, `entries`
    how much lies in each of them."""

    def __init__(self, spark: SparkSession, trail: Trail, options: IngestOptions,
                 last_keys: dict[tuple[str, str], str] | None = None):
        self.spark, self.trail, self.options = spark, trail, options
        self.last_keys = last_keys or {}
        self.asked: list[str] = []
        self.entries: dict[str, int] = {}
        self.root = trail_root(trail, options).rstrip("/")
        self.key_start = len(bucket_root(trail.bucket, options)) + 1

    def folders(self) -> Iterator[str]:
        """The folders in order of pairs; those of a few pairs are in memory at a time."""
        with ThreadPoolExecutor(THREADS) as pool:
            accounts = []
            for name in self._inside(self.root)[0]:
                if name.startswith("o-"):
                    accounts += [f"{self.root}/{name}/{a}" for a in self._inside(f"{self.root}/{name}")[0]]
                accounts.append(f"{self.root}/{name}")
            found = pool.map(lambda a: [(a, r) for r in self._inside(f"{a}/{TRAIL_FOLDER}")[0]], accounts)
            pairs = [p for some in found for p in some]
            for at in range(0, len(pairs), PAIRS):
                for some in pool.map(lambda p: list(self._below(*p)), pairs[at:at + PAIRS]):
                    yield from some

    def _listed(self, folder: str):
        """What is in a folder, in the JVM; nothing if it is not there."""
        self.asked.append(folder)
        fs, path = file_system(self.spark, folder)
        try:
            found = fs.listStatus(path)
            self.entries[folder] = len(found)
            return found
        except Py4JJavaError as e:
            if e.java_exception.getClass().getSimpleName() != "FileNotFoundException":
                raise
            return []

    def _inside(self, folder: str) -> tuple[list[str], list]:
        """The names of the folders in a folder, and the files, which stay in the JVM: each thing asked of one
        is a call, and there may be far more files than folders."""
        folders, files = [], []
        for s in self._listed(folder):
            if s.isDirectory():
                folders.append(s.getPath().getName())
            else:
                files.append(s)
        return folders, files

    def _below(self, account: str, region: str) -> Iterator[str]:
        """The parts of a region's folder that hold keys after the pair's last one."""
        last = self.last_keys.get((account.rsplit("/", 1)[1], region))
        here = f"{account}/{TRAIL_FOLDER}/{region}"
        yield from self._whole(here, 0) if last is None else self._after(here, last, 0)

    def _whole(self, here: str, level: int) -> Iterator[str]:
        """A folder as the folders in it that hold files."""
        names = []
        for s in self._listed(here) if level < LEVELS else []:
            if not s.isDirectory():
                # One file tells: the others are not asked.
                names = []
                break
            names.append(s.getPath().getName())
        if not names:
            yield here
        for name in names:
            yield from self._whole(f"{here}/{name}", level + 1)

    def _after(self, here: str, last: str, level: int) -> Iterator[str]:
        """The parts of the folder of the last read key that hold later ones."""
        folders, files = self._inside(here) if level < LEVELS else ([], [])
        if not folders:
            yield here
            return
        for path in (f"{here}/{s.getPath().getName()}" for s in files):
            if _bytes(path[self.key_start:]) > _bytes(last):
                yield path
        for name in folders:
            path = f"{here}/{name}"
            key = path[self.key_start:]
            if last.startswith(f"{key}/"):
                yield from self._after(path, last, level + 1)
            elif _bytes(f"{key}/") > _bytes(last):
                yield from self._whole(path, level + 1)


def _bytes(key: str) -> bytes:
    return key.encode()


def _last_keys(after: DataFrame | None, trail: Trail) -> dict[tuple[str, str], str]:
    """One row for each account and region read before."""
    if after is None:
        return {}
    mine = after.filter((F.col("bucket") == trail.bucket) & (F.col("prefix") == (trail.prefix or "")))
    rows = mine.select("account_id", "region", "last_processed_key").collect()
    return {(r.account_id, r.region): r.last_processed_key for r in rows if r.last_processed_key}


def _list_folders(spark, trail: Trail, rank: int, options: IngestOptions, suffix: str, folders: list[str]) -> DataFrame:
    def load():
        # `content` is never selected, so no file is opened.
        return (spark.read.format("binaryFile")
                .option("recursiveFileLookup", True)
                .option("pathGlobFilter", f"*{suffix}")
                .option("ignoreMissingFiles", True)
                .load([glob_escaped(f) for f in folders])
                .select("path", "length", "modificationTime"))

    found = load_or_empty(spark, "path string, length bigint, modificationTime timestamp", load)
    root = bucket_root(trail.bucket, options)
    return found.select(
        F.lit(trail.name).alias("trail"), F.lit(rank).alias("trail_rank"),
        F.lit(trail.bucket).alias("bucket"), F.lit(trail.prefix or "").alias("prefix"),
        object_key("path", root).alias("key"), "path",
        F.col("length").alias("size"), F.col("modificationTime").alias("last_modified"))


def _chunks(spark, trails: list[Trail], options: IngestOptions, suffix: str, after) -> Iterator[list[DataFrame]]:
    """Listings of at most `list_folders` folders together, and of no more once they hold `LIST_FILES` files."""
    parts, left, files = [], options.list_folders, LIST_FILES
    for rank, trail in enumerate(trails):
        walk, some = Walk(spark, trail, options, _last_keys(after, trail)), []
        for folder in walk.folders():
            some.append(folder)
            left -= 1
            files -= walk.entries.pop(folder, 1)
            if left <= 0 or files <= 0:
                yield [*parts, _list_folders(spark, trail, rank, options, suffix, some)]
                parts, some, left, files = [], [], options.list_folders, LIST_FILES
        if some:
            parts.append(_list_folders(spark, trail, rank, options, suffix, some))
    if parts:
        yield parts


def list_objects(spark: SparkSession, trails: Iterable[Trail] | DataFrame, options: IngestOptions,
                 suffix: str = LOG_SUFFIX, after: DataFrame | None = None, path: str | None = None) -> DataFrame:
    """The log objects in the trail folders of all accounts and regions of all trails.

    With checkpoints in `after`, folders that end before the last read key of their pair are not
    listed; objects at or below that key may still be among the rows. A listing of more than one chunk is
    written down chunk by chunk below `path` (a scratch folder by default) and read from there, by tasks of many
    files each.
    """
    def joined(parts: list[DataFrame]) -> DataFrame:
        return reduce(DataFrame.unionByName, parts)

    chunks = _chunks(spark, as_trails(trails), options, suffix, after)
    first, second = next(chunks, None), next(chunks, None)
    if second is None:
        return spark.createDataFrame([], OBJECT) if first is None else joined(first)
    path = path or scratch(spark, "listing")
    with small_files(spark):
        for parts in chain([first, second], chunks):
            joined(parts).write.mode("append").parquet(path)
    return spark.read.schema(OBJECT).parquet(path)


def distinct_objects(objects: DataFrame) -> DataFrame:
    """One row per object; trails that share a folder do not read it twice."""
    others = [c for c in objects.columns if c not in ("bucket", "key", "trail_rank")]
    first = F.min(F.struct("trail_rank", *others)).alias("_first")
    return objects.groupBy("bucket", "key").agg(first).select("_first.*", "bucket", "key").select(*objects.columns)
