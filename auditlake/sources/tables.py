"""The tables an ingest keeps below its root folder.

Every table is a set of `run_id=...` folders. A run counts once its file in `commits` is there; it is
made last, and only one writer can make it, so folders of a broken run are never read.
"""

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..schemas import CHECKPOINT, FAILED_FILE, METRICS, SEEN
from ..session import read_file
from .paths import load_or_empty


#: What `seen_segments` gives.
IdFolders = tuple[list[tuple[str, str, int]], list[str]]


def table_path(root: str, table: str, run_id: str | None = None) -> str:
    base = f"{root.rstrip('/')}/{table}"
    return base if run_id is None else f"{base}/run_id={run_id}"


def read_commits(spark: SparkSession, root: str, table: str = "commits") -> DataFrame:
    """(seq, run_id) of the runs that count: one small file each."""
    return load_or_empty(spark, "seq bigint, run_id string",
                         lambda: spark.read.schema("seq bigint, run_id string").json(table_path(root, table)))


def commit_file(root: str, seq: int, kind: str = "") -> str:
    return f"{table_path(root, f'{kind}commits')}/{seq:08d}.json"


def committed_runs(spark: SparkSession, root: str) -> list[tuple[int, str]]:
    """`(seq, run_id)` of every committed run, oldest first: one small row per run."""
    return sorted((r.seq, r.run_id) for r in read_commits(spark, root).collect())


def later_runs(spark: SparkSession, root: str, runs: list[tuple[int, str]]) -> list[tuple[int, str]]:
    """`committed_runs` by one who knew `runs` of them: each run's number follows the last one's."""
    runs = list(runs)
    while (text := read_file(spark, commit_file(root, runs[-1][0] + 1 if runs else 1))) is not None:
        found = json.loads(text)
        runs.append((found["seq"], found["run_id"]))
    return runs


def read_metrics(spark: SparkSession, root: str) -> DataFrame:
    """One row for each committed run."""
    found = load_or_empty(spark, METRICS, lambda: spark.read.schema(METRICS).json(table_path(root, "metrics")))
    return found.join(read_commits(spark, root).select("run_id"), "run_id", "left_semi").select(*METRICS.names)


def _read_runs(spark, root, table, schema: StructType, run_ids, read) -> DataFrame:
    if not run_ids:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema).option("basePath", table_path(root, table))
    return read(reader, [table_path(root, table, r) for r in run_ids])


def _runs(spark, root, runs):
    return [r for _, r in committed_runs(spark, root)] if runs is None else runs


def _latest(spark, root, table, schema, runs) -> DataFrame:
    return _read_runs(spark, root, table, schema, _runs(spark, root, runs)[-1:],
                      lambda reader, paths: reader.parquet(*paths)).select(*schema.names)


def read_checkpoints(spark: SparkSession, root: str, runs=None) -> DataFrame:
    """Checkpoints as the last committed run left them."""
    return _latest(spark, root, "checkpoints", CHECKPOINT, runs)


def read_failed_files(spark: SparkSession, root: str, runs=None) -> DataFrame:
    return _latest(spark, root, "failed_files", FAILED_FILE, runs)


def seen_segments(spark: SparkSession, root: str, runs: list[str]) -> IdFolders:
    """Merged id folders `(first run, last run, ids)` that cover the oldest of `runs`, oldest first, and
    the runs behind them, whose ids lie in folders of their own."""
    marks = load_or_empty(spark, "first string, ids bigint, run_id string", lambda: spark.read.schema(
        "first string, ids bigint, run_id string").json(table_path(root, "seen_base_done")))
    found = {(r.first, r.run_id): r.ids for r in marks.collect()}
    place = {r: i for i, r in enumerate(runs)}
    ends: dict[int, list[tuple[int, int]]] = {}
    for (first, last), ids in found.items():
        if first in place and last in place:
            ends.setdefault(place[last], []).append((place[first], ids))
    at, segments = max(ends, default=-1), []
    behind = runs[at + 1:]
    while at >= 0:
        # Of the segments that end here the widest: it was made from the others.
        first, ids = min(ends[at])
        segments.append((runs[first], runs[at], ids))
        at = first - 1
    return segments[::-1], behind


def segment_id(first: str, last: str) -> str:
    return f"{first}..{last}"


def read_seen(spark: SparkSession, root: str, runs=None, folders: IdFolders | None = None) -> DataFrame:
    """Ids of all events written by committed runs: merged folders and what came after, `folders` if they are known."""
    runs = _runs(spark, root, runs)
    segments, behind = folders or seen_segments(spark, root, runs)

    def read(reader, paths):
        return reader.parquet(*paths).select(*SEEN.names)

    old = _read_runs(spark, root, "seen_base", SEEN, [segment_id(a, b) for a, b, _ in segments], read)
    new = _read_runs(spark, root, "seen", SEEN, behind, read)
    return new if not segments else old if not behind else old.unionByName(new)
