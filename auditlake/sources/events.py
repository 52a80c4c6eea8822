"""The stored events as the manifests of committed runs and merges tell them."""

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.paths import glob_escaped
from ..schemas import MANIFEST, REPLACED, ROUTE, STORED_EVENT
from ..session import folders_in, java_paths, list_in_few_tasks
from .tables import _read_runs, committed_runs, read_commits, table_path


#: Folders asked for at the same time.
THREADS = 16


def committed_merges(spark: SparkSession, root: str) -> list[tuple[int, str]]:
    """`(seq, id)` of every committed merge of hours, oldest first."""
    return sorted((r.seq, r.run_id) for r in read_commits(spark, root, "merge_commits").collect())


def read_replaced(spark: SparkSession, root: str, merges: list[str]) -> DataFrame:
    """(old_run, folder) of the hour folders whose events merges have written anew."""
    return _read_runs(spark, root, "replaced", REPLACED, merges, lambda reader, paths: reader.parquet(*paths))


def event_files(spark: SparkSession, root: str) -> DataFrame:
    """The files that hold the events now: `run_id`, `folder` below it, route, `file`, `rows`, `bytes`.

    Runs and merges are taken as they are committed when this is called; the files of one snapshot stay
    until the next merge but one.
    """
    merges = [m for _, m in committed_merges(spark, root)]
    writers = [r for _, r in committed_runs(spark, root)] + merges
    files = _read_runs(spark, root, "manifest", MANIFEST, writers, lambda reader, paths: reader.parquet(*paths))
    gone = read_replaced(spark, root, merges).select(F.col("old_run").alias("run_id"), "folder")
    return files.join(gone, ["run_id", "folder"], "left_anti").select(*MANIFEST.names)


def event_folders(spark: SparkSession, root: str) -> DataFrame:
    """`event_files` added up by hour folder: `files`, `rows`, `bytes`."""
    return event_files(spark, root).groupBy("run_id", "folder", *ROUTE).agg(
        F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes"))


def _day_folders(spark: SparkSession, root: str, folder: str) -> list[str]:
    """A run's folder as the folders of its days, one for each account, region and day.

    Spark lists a folder below which no level has more than a few folders one after another on the driver,
    and a run's hours may be many thousands; many folders it lists by tasks.
    """
    names = folders_in(spark, f"{table_path(root, 'events')}/{folder}")
    if "_spark_metadata" in names:
        # Written by Spark's own sink, whose log tells which files count.
        return [folder]
    found = [f"{folder}/{n}" for n in names if "=" in n]
    with ThreadPoolExecutor(THREADS) as pool:
        for _ in ROUTE[1:-1]:
            inside = pool.map(lambda f: folders_in(spark, f"{table_path(root, 'events')}/{f}"), found)
            found = [f"{f}/{n}" for f, some in zip(found, inside) for n in some if "=" in n]
    return found


def event_lines_in(spark: SparkSession, root: str, folders: list[str], **options) -> DataFrame | None:
    """The text below folders of the events table, with run and route; None if there is none, as of runs
    without new events."""
    base = table_path(root, "events")
    # The reader needs one folder of an hour to know the columns.
    found = [at for f in folders for at in ([f] if "/" in f else [glob_escaped(d) for d in _day_folders(spark, root, f)])]
    if not found:
        return None
    list_in_few_tasks(spark)
    reader = spark.read.schema(STORED_EVENT).option("basePath", base).options(**options)
    return DataFrame(reader._jreader.text(java_paths(spark, [f"{base}/{f}" for f in found])), spark)


def read_events(spark: SparkSession, root: str, runs=None, where: Column | None = None) -> DataFrame:
    """Stored lines with their route; an empty region comes back as ''.

    `where` is a condition on the route (and on `run_id`): folders that do not meet it are not even
    listed. With `runs`, what these runs wrote is read, as they wrote it.
    """
    if runs is not None:
        lines = event_lines_in(spark, root, [f"run_id={r}" for r in runs])
    elif where is None and not committed_merges(spark, root):
        lines = event_lines_in(spark, root, [f"run_id={r}" for _, r in committed_runs(spark, root)])
    else:
        found = event_folders(spark, root).filter(F.lit(True) if where is None else where)
        # One row for each hour folder that is read, as in Spark's own index of them.
        lines = event_lines_in(spark, root, [f"run_id={r.run_id}/{r.folder}" for r in found.select("run_id", "folder").collect()])
    if lines is None:
        return spark.createDataFrame([], STORED_EVENT)
    lines = lines.withColumn("region", F.coalesce("region", F.lit("")))
    return lines if where is None else lines.filter(where)
