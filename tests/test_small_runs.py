"""What a run of few files and a micro-batch cost beside their rows, and what the driver holds of a listing."""

import os

from py4j.java_collections import ListConverter
from pyspark.sql import functions as F

from auditlake import Trail, ingest_batch, merge_hours
from auditlake.operators import log_objects
from auditlake.plans import ingest as plan
from auditlake.session import (DEFAULT_PARTS, LEAF_PARTS, LOCAL_CHECKPOINTS, LOCAL_FILES, SHUFFLE_PARTS, STATE_PROVIDER,
                               few_rows, plain_local_files, run_folders)
from auditlake.sources import committed_runs, known_ids, list_objects, listing, read_events, tables
from auditlake.streaming import stream_dedup, stream_events, stream_log_files, stream_write

from helpers import TRAIL, event, key, log, options, put, rows


def checked(spark, on):
    spark._jvm.org.apache.hadoop.fs.FileSystem.getLocal(spark._jsc.hadoopConfiguration()).setWriteChecksum(on)


def names_below(path):
    return [f for _, _, files in os.walk(path) for f in files]


def test_few_files_stay_with_the_driver(spark, tmp_path, monkeypatch):
    for i in (3, 1, 2):
        put(tmp_path, key(f"{i}.json.gz"), log(event(str(i))))
    files = log_objects(list_objects(spark, [TRAIL], options(tmp_path))).select("trail_rank", "bucket", "key", "path", "size")
    want = rows(plan.numbered_files(files))

    def is_local(df):
        return "LocalRelation" in df._jdf.queryExecution().optimizedPlan().toString()

    for most in (10, 100_000):
        found, count, size = plan.taken(files, most, f"{tmp_path}/files{most}")
        assert rows(found) == want and count == 3 and size == sum(r[4] for r in want) and is_local(found)
    assert [r[5] for r in sorted(want, key=lambda r: r[2])] == [1, 2, 3]
    monkeypatch.setattr(plan, "FEW_FILES", 2)
    for most in (2, 100_000):
        found, count, size = plan.taken(files, most, f"{tmp_path}/more{most}")
        assert rows(found) == want and count == 3 and size == sum(r[4] for r in want) and not is_local(found)


def test_a_large_and_a_small_run_are_alike(spark, tmp_path, monkeypatch):
    """Files that are read by a list of the driver's or by one written down."""
    for i in range(6):
        put(tmp_path, key(f"{i}.json.gz"), log(event(str(i)), event(str(i + 1)), event("x", time="no")))
    put(tmp_path, key("bad.json.gz"), "no log", compress=False)
    found = []
    for i, few in enumerate((1_000, 0)):
        monkeypatch.setattr(plan, "FEW_FILES", few)
        lake = f"{tmp_path}/lake{i}"
        made = ingest_batch(spark, [TRAIL], lake, options(tmp_path, max_files=4)).drop(
            "run_id", "elapsed_seconds", "finished_at", "jsonl_files", "download_rate", "event_rate", "mib_per_second")
        found.append((rows(made), rows(read_events(spark, lake)), rows(plan.read_checkpoints(spark, lake).drop("last_updated")),
                      rows(plan.read_failed_files(spark, lake), "key", "attempts")))
    assert found[0][0] == found[1][0] and [r[0] for r in found[0][1]] == [r[0] for r in found[1][1]]
    assert found[0][2:] == found[1][2:] and len(found[0][1]) == 7 and len(found[0][3]) == 1


def test_a_run_asks_once_where_ids_lie_and_what_was_committed(spark, tmp_path, monkeypatch):
    for i in range(6):
        put(tmp_path, key(f"{i}.json.gz"), log(event(str(i)), event(str(i + 1))))
    asked, read = [], []
    one, commits = tables.seen_segments, tables.committed_runs

    def counted(*args):
        asked.append(args)
        return one(*args)

    def counted_commits(*args):
        read.append(args)
        return commits(*args)

    for module in (plan, known_ids, tables):
        monkeypatch.setattr(module, "seen_segments", counted)
    for module in (plan, tables):
        monkeypatch.setattr(module, "committed_runs", counted_commits)
    lake = f"{tmp_path}/lake"
    made = ingest_batch(spark, [TRAIL], lake, options(tmp_path, max_files=2))
    # Three runs, of which two find known events.
    assert made.count() == 3 and len(asked) == 3 and len(read) == 1
    assert sorted(r[0] for r in rows(read_events(spark, lake), "value")) == sorted(event(str(i)) for i in range(7))


def test_later_runs_are_those_committed_since(spark, tmp_path):
    lake, known = f"{tmp_path}/lake", []
    for i in range(3):
        put(tmp_path, key(f"{i}.json.gz"), log(event(str(i))))
        ingest_batch(spark, [TRAIL], lake, options(tmp_path))
        found = tables.later_runs(spark, lake, known)
        assert found == committed_runs(spark, lake) and len(found) == i + 1
        known = known if i else found
    assert tables.later_runs(spark, lake, found) == found


def test_tables_on_local_paths_have_no_checksum_files(spark, tmp_path):
    for i in range(4):
        put(tmp_path, key(f"{i}.json.gz"), log(event(str(i)), event(str(i), time="2024-01-02T05:06:07Z")))
    lake, before = f"{tmp_path}/lake", spark.conf.get(STATE_PROVIDER)
    checked(spark, True)
    try:
        ingest_batch(spark, [TRAIL], lake, options(tmp_path, max_files=2, compact_every=2))
        merge_hours(spark, lake, options(tmp_path))
        made = stream_dedup(stream_events(stream_log_files(spark, f"{tmp_path}/b")))
        for i, kept in enumerate(("RocksDBStateStoreProvider", "HDFSBackedStateStoreProvider")):
            spark.conf.set(STATE_PROVIDER, f"org.apache.spark.sql.execution.streaming.state.{kept}")
            stream_write(made, f"{tmp_path}/s{i}/events/run_id=1", f"{tmp_path}/state{i}", once=True).awaitTermination()
            assert read_events(spark, f"{tmp_path}/s{i}", ["1"]).count() == 4
    finally:
        checked(spark, False)
        spark.conf.set(STATE_PROVIDER, before)
    found = [f for t in ("events", "seen", "seen_base", "bloom", "manifest", "checkpoints", "metrics") for f in names_below(f"{lake}/{t}")]
    streamed = [f for t in ("s1", "state1/state", "state1/commits", "state0/commits") for f in names_below(f"{tmp_path}/{t}")]
    assert found and not [f for f in found if f.endswith(".crc") or f == "_SUCCESS"]
    # Spark's own checksums of its state stay.
    assert streamed and not [f for f in streamed if f.startswith(".")]
    assert all(spark.conf.get(k, None) is None for k in (*LOCAL_FILES, *LOCAL_CHECKPOINTS))
    assert read_events(spark, lake).count() == 4


def test_settings_of_the_session_stay(spark):
    spark.conf.set("fs.file.impl", "org.apache.hadoop.fs.LocalFileSystem")
    try:
        with plain_local_files(spark), run_folders(spark):
            assert spark.conf.get("fs.file.impl").endswith(".LocalFileSystem")
            assert spark.conf.get("fs.file.impl.disable.cache", None) is None
    finally:
        spark.conf.unset("fs.file.impl")
    before = spark.conf.get(SHUFFLE_PARTS)
    try:
        for width, inside in ((DEFAULT_PARTS, str(spark.sparkContext.defaultParallelism)), ("7", "7")):
            spark.conf.set(SHUFFLE_PARTS, width)
            with few_rows(spark):
                assert spark.conf.get(SHUFFLE_PARTS) == inside and spark.conf.get(LEAF_PARTS) == "1"
            assert spark.conf.get(SHUFFLE_PARTS) == width and spark.conf.get(LEAF_PARTS, None) is None
    finally:
        spark.conf.set(SHUFFLE_PARTS, before)


def test_a_stream_of_many_batches_is_read_back(spark, tmp_path):
    """Readers find the entries of a sink's log by the session's interval, whatever the stream was started with."""
    for i in range(12):
        put(tmp_path, key(f"{i}.json.gz"), log(event(str(i))))
    events = stream_events(stream_log_files(spark, f"{tmp_path}/b", max_files=1))
    stream_write(events, f"{tmp_path}/lake/events/run_id=1", f"{tmp_path}/state", once=True).awaitTermination()
    assert "9.compact" in os.listdir(f"{tmp_path}/lake/events/run_id=1/_spark_metadata")
    assert read_events(spark, f"{tmp_path}/lake", ["1"]).count() == 12


def test_paths_of_events_go_to_the_reader_as_one_text(spark, tmp_path, monkeypatch):
    put(tmp_path, key("1.json.gz"), log(event("1"), event("2", time="2024-01-02T05:06:07Z")))
    lake = f"{tmp_path}/lake"
    ingest_batch(spark, [TRAIL], lake, options(tmp_path))
    sent, convert = [], ListConverter.convert
    monkeypatch.setattr(ListConverter, "convert", lambda self, items, client: sent.extend(items) or convert(self, items, client))
    lines = read_events(spark, lake, where=F.col("account_id") == "000000000001")
    assert not [s for s in sent if "account_id=" in str(s)] and lines.count() == 2


def test_a_listing_holds_few_files_of_many_in_few_folders(spark, tmp_path, monkeypatch):
    keys = [key(f"2024/0{m}/{n}.json.gz", region=r) for r in ("r0", "r1") for m in (1, 2, 3) for n in range(5)]
    for k in keys:
        put(tmp_path, k, "")
    held, one = [], listing._list_folders

    def counted(*args):
        found = one(*args)
        held.append((len(args[-1]), found.count()))
        return found

    monkeypatch.setattr(listing, "_list_folders", counted)
    monkeypatch.setattr(listing, "LIST_FILES", 8)
    found = list_objects(spark, [TRAIL, Trail("second", "b", "")], options(tmp_path))
    assert rows(found, "trail_rank", "key") == sorted((i, k) for i in (0, 1) for k in keys)
    # A folder more is taken until there are 8 files.
    assert max(n for _, n in held) == 10 and sum(f for f, _ in held) == 12
