"""Whole runs, batch and stream."""

import collections
import json
import os
import time

import pytest
from py4j.java_collections import ListConverter

from pyspark.sql import functions as F

from auditlake import Trail, ingest_batch, merge_hours, requeue_files
from auditlake.operators import log_objects, loser_bitmaps
from auditlake.operators import losers as lose
from auditlake.plans import ingest as plan
from auditlake.schemas import ROUTE
from auditlake.session import (DEFAULT_PARTS, LEAST_STATE_PARTS, LISTERS, LISTING_TASKS, SHUFFLE_PARTS, STATE_PARTS, at_once,
                               create_file)
from auditlake.sinks import event_lines, events as sink_events, write_events, write_seen
from auditlake.sources import event_files, known_among, list_objects
from auditlake.sources.known_ids import narrowed
from auditlake.sources import (committed_runs, known_layers, read_checkpoints, read_events, read_failed_files,
                               read_metrics, read_seen)
from auditlake.sources import events as sources_events, listing
from auditlake.sources.listing import Walk
from auditlake.sources.log_files import read_log_files
from auditlake.sources.tables import seen_segments
from auditlake.sinks.tables import Claimed, claimed, compact_seen
from auditlake.streaming import objects, stream_checkpoints, stream_files, stream_state
from auditlake.streaming.state import last_batch
from auditlake.streaming import (ProgressLog, checkpoint_table, drained, stream_bad_files, stream_dedup, stream_events, stream_ingest,
                                 stream_log_files, stream_write)

from helpers import TRAIL, event, key, log, options, put, rows


def run(spark, tmp_path, trails=(TRAIL,), **changes):
    """One call; its counters, added up over its runs."""
    made = ingest_batch(spark, trails, str(tmp_path / "lake"), options(tmp_path, **changes)).collect()
    total = collections.Counter()
    for r in made:
        total.update({k: v for k, v in r.asDict().items() if k.startswith(("files", "events", "errors", "bytes", "hour", "jsonl"))})
        assert r.events_processed == (r.events_written + r.events_duplicate + r.events_malformed
                                      + r.events_bad_time + r.events_no_account)
    return total


def values(spark, tmp_path):
    return [v for v, in rows(read_events(spark, str(tmp_path / "lake")), "value")]


def test_run_and_rerun(spark, tmp_path):
    a, b, c = event("a"), event("b", region=None, account="000000000007"), event("c", time="2024-01-02T23:59:59.5-07:00")
    put(tmp_path, key("1.json.gz"), log(a, a, event(7), "null", event("x", time="no"), event("y", account="")))
    put(tmp_path, key("2.json.gz"), log(a, b, c))
    put(tmp_path, key("3.json.gz"), '{"Records":null}')
    m = run(spark, tmp_path)
    assert (m["events_processed"], m["events_written"], m["events_duplicate"]) == (9, 3, 2)
    assert (m["events_malformed"], m["events_bad_time"], m["events_no_account"]) == (2, 1, 1)
    assert (m["files_listed"], m["files_processed"], m["errors"], m["hour_buffers"]) == (3, 3, 0, 3)
    assert m["bytes_downloaded"] == sum(
        os.path.getsize(tmp_path / "b" / key(f"{i}.json.gz")) for i in (1, 2, 3))
    lake = str(tmp_path / "lake")
    events = read_events(spark, lake)
    assert rows(events, "account_id", "region", "year", "month", "day", "hour", "value") == sorted([
        ("000000000001", "us-east-1", "2024", "01", "01", "05", a),
        ("000000000007", "", "2024", "01", "01", "05", b),
        ("000000000001", "us-east-1", "2024", "01", "02", "23", c)])
    before = rows(read_checkpoints(spark, lake).drop("last_updated"))
    assert before == [("b", "", "000000000001", "us-east-1", key("3.json.gz"), 3, 1)]
    assert run(spark, tmp_path)["files_listed"] == 0
    assert len(values(spark, tmp_path)) == 3

    # Later files: one repeat over runs, one new event, one late file below the mark.
    put(tmp_path, key("4.json.gz"), log(b, event("d")))
    put(tmp_path, key("0.json.gz"), log(event("late")))
    m = run(spark, tmp_path)
    assert (m["files_listed"], m["events_written"], m["events_duplicate"]) == (1, 1, 1)
    assert rows(read_seen(spark, lake), "event_id") == [("a",), ("b",), ("c",), ("d",)]
    assert len(committed_runs(spark, lake)) == 2


def test_bad_files_are_tried_again_until_given_up(spark, tmp_path):
    put(tmp_path, key("1.json.gz"), "{")
    put(tmp_path, key("2.json.gz"), log(event("a")))
    put(tmp_path, key("3.json.gz"), "")
    lake = str(tmp_path / "lake")
    soon = {"retry_seconds": 0, "give_up_after": 2}
    m = run(spark, tmp_path)
    assert (m["files_listed"], m["files_processed"], m["errors"], m["events_written"]) == (3, 1, 2, 1)
    assert (m["files_downloaded"], m["jsonl_files"]) == (2, 1)
    assert run(spark, tmp_path, **soon)["errors"] == 0
    assert requeue_files(spark, lake) == 2
    assert rows(read_failed_files(spark, lake), "key", "attempts") == [(key("1.json.gz"), 1), (key("3.json.gz"), 1)]
    put(tmp_path, key("3.json.gz"), log(event("b")))
    m = run(spark, tmp_path, **soon)
    assert (m["files_listed"], m["files_processed"], m["errors"], m["events_written"]) == (0, 1, 1, 1)
    assert rows(read_failed_files(spark, lake), "key", "attempts") == [(key("1.json.gz"), 2)]
    assert run(spark, tmp_path, **soon)["errors"] == 0
    put(tmp_path, key("4.json.gz"), log(event("c")))
    run(spark, tmp_path, **soon)
    assert rows(read_failed_files(spark, lake), "key", "attempts") == [(key("1.json.gz"), 2)]
    # Given up, but not forgotten.
    put(tmp_path, key("1.json.gz"), log(event("d")))
    assert run(spark, tmp_path, **soon)["events_written"] == 0
    assert requeue_files(spark, lake, F.col("key") == key("1.json.gz")) == 1
    assert run(spark, tmp_path, **soon)["events_written"] == 1
    assert read_failed_files(spark, lake).count() == 0


def test_many_small_runs_equal_one(spark, tmp_path):
    for account in ("000000000001", "000000000002"):
        for i in range(5):
            put(tmp_path, key(f"{i}.json.gz", account=account), log(*[event(f"e{j}") for j in range(i, i + 4)]))
    m = run(spark, tmp_path, max_files=3)
    lake = str(tmp_path / "lake")
    assert [seq for seq, _ in committed_runs(spark, lake)] == [1, 2, 3, 4]
    assert (m["files_listed"], m["events_processed"], m["events_written"]) == (10, 40, 8)
    assert rows(read_seen(spark, lake), "event_id") == [(f"e{j}",) for j in range(8)]
    assert rows(read_checkpoints(spark, lake), "account_id", "last_processed_key", "files_processed") == [
        (a, key("4.json.gz", account=a), 5) for a in ("000000000001", "000000000002")]


@pytest.mark.parametrize("every", [1, 2])
def test_merged_ids_are_all_ids(spark, tmp_path, every):
    for i in range(3):
        put(tmp_path, key(f"{i}.json.gz"), log(*[event(f"e{j}") for j in range(2 * i, 2 * i + 3)]))
    m = run(spark, tmp_path, max_files=1, compact_every=every)
    assert (m["events_written"], m["events_duplicate"]) == (7, 2)
    lake = str(tmp_path / "lake")
    runs = [r for _, r in committed_runs(spark, lake)]
    segments, behind = seen_segments(spark, lake, runs)
    assert len(behind) == 3 % every and segments[0][0] == runs[0] and segments[-1][1] == runs[3 // every * every - 1]
    assert sum(n for *_, n in segments) + read_seen(spark, lake).filter(F.col("run_id").isin(behind)).count() == 7
    # What was merged is gone with the next merging, when no reader can be at it any more.
    compact_seen(spark, lake)
    put(tmp_path, key("9.json.gz"), log(event("e0")))
    run(spark, tmp_path, compact_every=1)
    runs = [r for _, r in committed_runs(spark, lake)]
    assert os.listdir(f"{lake}/seen") == [f"run_id={runs[-1]}"]
    assert seen_segments(spark, lake, runs)[1] == []
    assert rows(read_seen(spark, lake), "event_id") == [(f"e{j}",) for j in range(7)]


def test_a_broken_run_leaves_no_trace(spark, tmp_path, monkeypatch):
    put(tmp_path, key("1.json.gz"), log(event("a"), event("b")))

    def fail(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(plan, "write_metrics", fail)
    with pytest.raises(RuntimeError):
        run(spark, tmp_path)
    monkeypatch.undo()
    assert values(spark, tmp_path) == []
    m = run(spark, tmp_path)
    assert (m["events_written"], m["events_duplicate"]) == (2, 0)
    assert values(spark, tmp_path) == sorted([event("a"), event("b")])


@pytest.mark.parametrize("broken", ["gone", "cut"])
def test_a_file_lost_between_the_scans_fails_the_run(spark, tmp_path, monkeypatch, broken):
    put(tmp_path, key("1.json.gz"), log(event("a"), event("b")))
    path = put(tmp_path, key("2.json.gz"), log(event("c"), event("b")))
    places = plan.losing_records

    def lost(*args):
        os.remove(path) if broken == "gone" else put(tmp_path, key("2.json.gz"), log(event("c"), event("b")), cut=9)
        return places(*args)

    monkeypatch.setattr(plan, "losing_records", lost)
    with pytest.raises(RuntimeError, match="wrote 2 of 3 events"):
        run(spark, tmp_path)
    monkeypatch.undo()
    assert values(spark, tmp_path) == []
    put(tmp_path, key("2.json.gz"), log(event("c"), event("b")))
    assert run(spark, tmp_path)["events_written"] == 3
    assert values(spark, tmp_path) == sorted([event("a"), event("b"), event("c")])


def test_trails_overlap(spark, tmp_path):
    """Shared folders are read once; between trails the first one's copy is kept."""
    trails = [Trail("one", "b", "z"), Trail("two", "b", ""), Trail("again", "b", "z")]
    put(tmp_path, key("1.json.gz", prefix="z", org="o-1"), log(event("a", src="z")))
    put(tmp_path, key("1.json.gz"), log(event("a", src="local"), event("b")))
    m = run(spark, tmp_path, trails)
    assert (m["files_listed"], m["events_written"], m["events_duplicate"]) == (2, 2, 1)
    assert values(spark, tmp_path) == sorted([event("a", src="z"), event("b")])
    marks = read_checkpoints(spark, str(tmp_path / "lake"))
    assert rows(marks, "prefix", "last_processed_key") == [
        ("", key("1.json.gz")), ("z", key("1.json.gz", prefix="z", org="o-1"))]


@pytest.mark.parametrize("keep, expect", [(False, 1), (True, 3)])
def test_records_without_id(spark, tmp_path, keep, expect):
    put(tmp_path, key("1.json.gz"), log(event(None, n=1), event("", n=2)))
    put(tmp_path, key("2.json.gz"), log(event(None, n=3)))
    assert run(spark, tmp_path, keep_missing_ids=keep)["events_written"] == expect
    put(tmp_path, key("3.json.gz"), log(event(None, n=4)))
    assert run(spark, tmp_path, keep_missing_ids=keep)["events_written"] == int(keep)


def test_lines_stay_lines_and_files_small(spark, tmp_path):
    records = [event(f"e{i}").replace(",", ",\r\n ", 1) for i in range(25)]
    put(tmp_path, key("1.json.gz"), log(*records))
    run(spark, tmp_path, events_per_file=10)
    assert values(spark, tmp_path) == sorted(r.replace("\r\n", "  ") for r in records)
    sizes = [len(open(os.path.join(d, f)).read().splitlines())
             for d, _, files in os.walk(tmp_path / "lake" / "events") for f in files if f.endswith(".txt")]
    assert sum(sizes) == 25 and max(sizes) <= 10


@pytest.mark.parametrize("changes", [
    {"dedup": "approx", "bloom_items": 10_000}, {"dedup": "exact"}, {"dedup": "exact", "prune_by_date": True},
    {"prune_by_date": True}, {"strict": False}])
def test_other_ways_give_the_same(spark, tmp_path, changes):
    put(tmp_path, key("1.json.gz"), log(*[event(f"e{i}", time=f"2024-01-0{i % 9 + 1}T00:00:00Z") for i in range(40)]))
    assert run(spark, tmp_path, **changes)["events_written"] == 40
    put(tmp_path, key("2.json.gz"), log(*[event(f"e{i}", time=f"2024-01-0{i % 9 + 1}T00:00:00Z") for i in range(30, 60)]))
    m = run(spark, tmp_path, **changes)
    assert (m["events_written"], m["events_duplicate"]) == (20, 10)
    assert os.path.exists(tmp_path / "lake" / "bloom") == (changes.get("dedup") != "exact")


def test_sketch_starts_from_exact_history(spark, tmp_path):
    put(tmp_path, key("1.json.gz"), log(event("a")))
    run(spark, tmp_path, dedup="exact")
    put(tmp_path, key("2.json.gz"), log(event("a"), event("b")))
    assert run(spark, tmp_path, dedup="approx", bloom_items=1000)["events_written"] == 1


@pytest.mark.parametrize("first, then", [(1000, 100_000), (100_000, 1000), (10, 10)])
def test_sketch_of_another_size_and_an_overfull_one(spark, tmp_path, first, then):
    put(tmp_path, key("1.json.gz"), log(*[event(f"e{i}") for i in range(300)]))
    assert run(spark, tmp_path, bloom_items=first)["events_written"] == 300
    for part in (2, 3):
        put(tmp_path, key(f"{part}.json.gz"), log(*[event(f"e{i}") for i in range(100 * part, 100 * part + 200)]))
    m = run(spark, tmp_path, bloom_items=then, max_files=1)
    assert (m["events_written"], m["events_duplicate"]) == (200, 200)


def test_a_run_without_hits_reads_no_ids(spark, tmp_path, monkeypatch):
    put(tmp_path, key("1.json.gz"), log(event("a")))
    run(spark, tmp_path)
    put(tmp_path, key("2.json.gz"), log(event("b")))
    monkeypatch.setattr(plan, "known_among", None)
    assert run(spark, tmp_path)["events_written"] == 1


def test_one_writer_at_a_time(spark, tmp_path):
    put(tmp_path, key("1.json.gz"), log(event("a")))
    lake = str(tmp_path / "lake")
    with claimed(spark, lake, 1, 1):
        with pytest.raises(Claimed):
            run(spark, tmp_path)
    assert run(spark, tmp_path)["events_written"] == 1
    with claimed(spark, lake, 2, 1):
        put(tmp_path, key("2.json.gz"), log(event("b")))
        assert run(spark, tmp_path, claim_hours=0)["events_written"] == 1


def test_listing_goes_on_after_the_last_key(spark, tmp_path):
    names = [f"2024/01/{d:02d}/{n}.json.gz" for d in range(1, 6) for n in "ab"]
    for n in names[:6]:
        put(tmp_path, key(n), log(event(n)))
    put(tmp_path, key("2024/01/01/x.json.gz", account="000000000002"), log(event("other")))
    put(tmp_path, "AWSLogs/000000000001/CloudTrail-Digest/us-east-1/d.json.gz", "{}")
    assert run(spark, tmp_path)["files_listed"] == 7
    for n in names[6:]:
        put(tmp_path, key(n), log(event(n)))
    put(tmp_path, key("2024/01/03/c.json.gz"), log(event("c")))
    pair = ("000000000001", "us-east-1")
    walk = Walk(spark, TRAIL, options(tmp_path), {pair: key("2024/01/03/b.json.gz")})
    below = [f.split("us-east-1/")[1] for f in walk.folders() if "000000000001" in f]
    assert sorted(below) == ["2024/01/03", "2024/01/04", "2024/01/05"]
    assert not any("Digest" in f or f.endswith(("01/01", "01/02")) for f in walk.asked if "000000000002" not in f)
    assert run(spark, tmp_path)["files_listed"] == 5
    assert len(values(spark, tmp_path)) == 12


def test_glob_characters_in_a_prefix(spark, tmp_path):
    trail = Trail("t", "b", "x{1}[a]")
    put(tmp_path, key("1.json.gz", prefix=trail.prefix), log(event("a")))
    assert run(spark, tmp_path, [trail])["events_written"] == 1
    q = stream_ingest(spark, [trail], str(tmp_path / "lake2"), str(tmp_path / "state"), options(tmp_path), once=True)
    q.awaitTermination()
    assert read_events(spark, str(tmp_path / "lake2")).count() == 1


def test_trails_from_a_table(spark, tmp_path):
    put(tmp_path, key("1.json.gz", prefix="p"), log(event("a")))
    put(tmp_path, key("2.json.gz"), log(event("b")))
    table = spark.createDataFrame([("one", "b", "p"), ("two", "b", None)], "name string, bucket string, prefix string")
    assert run(spark, tmp_path, table)["events_written"] == 2
    q = stream_ingest(spark, table, str(tmp_path / "lake2"), str(tmp_path / "state"), options(tmp_path), once=True)
    q.awaitTermination()
    assert read_events(spark, str(tmp_path / "lake2")).count() == 2


def test_inventory_in_place_of_listing(spark, tmp_path):
    path = put(tmp_path, key("1.json.gz"), log(event("a")))
    put(tmp_path, key("2.json.gz"), log(event("b")))
    objects = spark.createDataFrame(
        [("t", 0, "b", "", key("1.json.gz"), path, 10, None)],
        "trail string, trail_rank int, bucket string, prefix string, key string, path string, size bigint, "
        "last_modified timestamp")
    made = ingest_batch(spark, [], str(tmp_path / "lake"), options(tmp_path), objects=objects).collect()
    assert [r.events_written for r in made] == [1]


def stream(spark, tmp_path, **changes):
    q = stream_ingest(spark, [TRAIL], str(tmp_path / "lake"), str(tmp_path / "state"),
                      options(tmp_path, retry_seconds=0, **changes), once=True)
    q.awaitTermination()


def test_stream_resumes_and_takes_late_keys(spark, tmp_path):
    put(tmp_path, key("5.json.gz"), log(event("a"), event("b"), event("a")))
    put(tmp_path, key("6.json.gz"), "{")
    stream(spark, tmp_path, max_files=1)
    put(tmp_path, key("1.json.gz"), log(event("b"), event("late")))
    put(tmp_path, key("6.json.gz"), log(event("c")))
    stream(spark, tmp_path, max_files=1)
    assert values(spark, tmp_path) == sorted(event(i) for i in ("a", "b", "c", "late"))
    lake = str(tmp_path / "lake")
    assert rows(checkpoint_table(spark, lake), "last_processed_key", "files_processed") == [(key("6.json.gz"), 3)]
    assert read_failed_files(spark, lake).count() == 0


def test_repeated_micro_batch_does_nothing(spark, tmp_path):
    put(tmp_path, key("1.json.gz"), log(event("a")))
    stream(spark, tmp_path)
    # As after a crash between the run's commit and the stream's own.
    for f in os.listdir(tmp_path / "state" / "commits"):
        os.remove(tmp_path / "state" / "commits" / f)
    stream(spark, tmp_path)
    assert values(spark, tmp_path) == [event("a")]
    assert read_metrics(spark, str(tmp_path / "lake")).count() == 1


@pytest.mark.parametrize("late", ["file_log", "high_water"])
def test_stream_takes_files_in_any_order_of_keys(spark, tmp_path, late):
    """Keys whose order differs from that of their times, one in each micro-batch."""
    for i, name in enumerate("4213"):
        path = put(tmp_path, key(f"{name}.json.gz"), log(event(name)))
        os.utime(path, (1_700_000_000 + 10 * i,) * 2)
    stream(spark, tmp_path, max_files=1, late=late)
    assert values(spark, tmp_path) == [event(n) for n in "1234"]


def test_a_second_query_does_not_repeat_run_ids(spark, tmp_path):
    put(tmp_path, key("1.json.gz"), log(event("a")))
    stream(spark, tmp_path)
    put(tmp_path, key("2.json.gz"), log(event("b")))
    q = stream_ingest(spark, [TRAIL], str(tmp_path / "lake"), str(tmp_path / "state2"), options(tmp_path), once=True)
    q.awaitTermination()
    assert values(spark, tmp_path) == [event("a"), event("b")]


def test_stream_edges(spark, tmp_path):
    with pytest.raises(ValueError):
        stream_ingest(spark, [], str(tmp_path / "lake"), str(tmp_path / "state"), options(tmp_path))
    os.makedirs(tmp_path / "b")
    stream(spark, tmp_path)
    put(tmp_path, key("1.json.gz"), log(event("a")))
    stream(spark, tmp_path)
    assert values(spark, tmp_path) == [event("a")]


def test_bad_files_of_the_declarative_stream(spark, tmp_path):
    put(tmp_path, key("1.json.gz"), log(event("a")))
    bad = [put(tmp_path, key("2.json.gz"), "{"), put(tmp_path, key("3.json.gz"), log(event("b")), compress=False),
           put(tmp_path, key("4.json.gz"), log(event("c")), cut=9)]
    out = str(tmp_path / "bad")
    for _ in range(2):
        stream_bad_files(spark, str(tmp_path / "b"), out, str(tmp_path / "state"), once=True).awaitTermination()
    found = {r.path.split("us-east-1/")[1] for r in spark.read.parquet(out).collect()}
    assert found == {os.path.basename(p) for p in bad}


def test_stream_after_backfill(spark, tmp_path):
    put(tmp_path, key("1.json.gz"), log(event("a")))
    run(spark, tmp_path)
    put(tmp_path, key("2.json.gz"), log(event("b")))
    stream(spark, tmp_path)
    assert values(spark, tmp_path) == sorted([event("a"), event("b")])


@pytest.mark.parametrize("horizon, expect", [(None, 2), ("1 hour", 2)])
def test_declarative_stream(spark, tmp_path, horizon, expect):
    for i in (1, 2):
        put(tmp_path, key(f"{i}.json.gz"), log(event("a"), event("a"), event(f"b")))
        files = stream_log_files(spark, str(tmp_path / "b"))
        events = stream_dedup(stream_events(files), horizon)
        stream_write(events, f"{tmp_path}/lake/events/run_id=1", f"{tmp_path}/state", once=True).awaitTermination()
    assert read_events(spark, str(tmp_path / "lake"), ["1"]).count() == expect


def test_progress_is_logged(spark, tmp_path, caplog):
    listener = ProgressLog()
    spark.streams.addListener(listener)
    try:
        put(tmp_path, key("1.json.gz"), log(event("a"), event("b"), event("c", time="no"), event(7)))
        with caplog.at_level("INFO", "auditlake.progress"):
            events = stream_events(stream_log_files(spark, str(tmp_path / "b")))
            stream_write(events, f"{tmp_path}/out", f"{tmp_path}/state", once=True).awaitTermination()
            for _ in range(100):
                lines = [json.loads(r.message) for r in caplog.records]
                if any(x.get("state") == "stopped" for x in lines):
                    break
                time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    seen = [x["observed"]["outcomes"] for x in lines if x.get("observed")]
    assert seen[0] == {"events": 4, "malformed": 1, "bad_time": 1, "no_account": 0}


def test_batch_equals_stream(spark, tmp_path):
    for i in range(6):
        put(tmp_path, key(f"{i}.json.gz", region=f"r{i % 2}"), log(*[event(f"e{j}", region=f"r{j % 3}") for j in range(i, i + 5)]))
    run(spark, tmp_path)
    q = stream_ingest(spark, [TRAIL], str(tmp_path / "other"), str(tmp_path / "state"), options(tmp_path), once=True)
    q.awaitTermination()
    cols = ("account_id", "region", "hour", "value")
    assert rows(read_events(spark, str(tmp_path / "lake")), *cols) == rows(read_events(spark, str(tmp_path / "other")), *cols)


def test_exploded_rows_do_not_reach_one_task(spark, tmp_path):
    """A hot id is combined before the shuffle: the group plan has a partial aggregate."""
    put(tmp_path, key("1.json.gz"), log(event("a")))
    records = spark.createDataFrame([(1, "b", "k", 0, 1, event("a"), None)], "file_no long, bucket string, key string, "
                                    "ordinal int, place long, raw string, _corrupt string")
    text = plan.group_rows(plan.narrow_rows(records, options(tmp_path)))._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in text and text.count("Exchange hashpartitioning") == 1
    # The text is neither sorted nor moved: a hash aggregate of fixed-width columns.
    assert "SortAggregate" not in text and "raw" not in text[:text.index("Exchange")]


def test_no_exchange_moves_the_text_but_the_sink(spark, tmp_path):
    """Half of all records are copies, and still the plan of the text is one scan with broadcasts."""
    for i in range(4):
        put(tmp_path, key(f"{i}.json.gz"), log(*[event(f"e{i // 2}-{j}") for j in range(50)]))
    files = plan.numbered_files(log_objects(list_objects(spark, [TRAIL], options(tmp_path))))
    read = plan.opened(spark, files)
    rows_ = plan.narrow_rows(plan.scan_records(read, files), options(tmp_path))
    groups = plan.group_rows(rows_).withColumn("is_seen", F.lit(False))
    losers = loser_bitmaps(plan.losing_records(rows_, groups))
    written = f"{tmp_path}/losers"
    losers.write.parquet(written)
    new = plan.new_events(read, files, spark.read.parquet(written), options(tmp_path))
    lines = event_lines(new)
    text = lines._jdf.queryExecution().executedPlan().toString()
    above = text[:text.index("Scan json")]
    assert "BroadcastHashJoin" in above and "Exchange hashpartitioning" not in above and "SortMergeJoin" not in text
    assert lines.count() == 100


def test_losers_of_several_parts_and_ranges(spark, tmp_path, monkeypatch):
    """More than 32,768 records in a file, and more bitmaps than may be broadcast together."""
    monkeypatch.setattr(lose, "MAX_BYTES", 100)
    monkeypatch.setattr(plan.lose.scan_ranges, "__defaults__", (100,))
    records = [event(f"e{i % 40_000}") for i in range(70_000)]
    put(tmp_path, key("1.json.gz"), log(*records))
    for i in range(2, 6):
        put(tmp_path, key(f"{i}.json.gz"), log(event(f"f{i}"), event("e39999"), *[event("g")] * 70))
    m = run(spark, tmp_path)
    assert (m["events_written"], m["events_duplicate"]) == (40_005, 30_000 + 4 + 4 * 70 - 1)
    assert values(spark, tmp_path) == sorted([event(f"e{i}") for i in range(40_000)] + [event(f"f{i}") for i in range(2, 6)] + [event("g")])


@pytest.mark.parametrize("counts", [(4, 64, 16), (64, 3, 1)])
def test_any_number_of_id_folders(spark, tmp_path, counts):
    """Known events are found whatever number of folders each run dealt its ids to."""
    put(tmp_path, key("0.json.gz"), log(*[event(f"e{i}") for i in range(200)]))
    assert run(spark, tmp_path, id_buckets=counts[0])["events_written"] == 200
    for i, n in enumerate(counts[1:]):
        put(tmp_path, key(f"{i + 1}.json.gz"), log(event("e3"), event("e150"), event(f"new{i}")))
        m = run(spark, tmp_path, id_buckets=n, dedup=("approx", "exact")[i], compact_every=2)
        assert (m["events_written"], m["events_duplicate"]) == (1, 2)


def test_a_few_hits_read_few_pages(spark, tmp_path):
    """A hundred hits against a million ids."""
    lake = str(tmp_path / "lake")
    ids = spark.range(1_000_000).select(F.sha2(F.col("id").cast("string"), 224).alias("event_id"), F.lit("2024-01-01").alias("event_date"))
    write_seen(ids, lake, "1")
    assert create_file(spark, f"{lake}/commits/1.json", '{"seq": 1, "run_id": "1"}')
    size = sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(f"{lake}/seen") for f in files)
    hits = ids.filter("event_id < '0007'").unionByName(spark.range(50).select(
        F.concat(F.lit("new"), "id").alias("event_id"), F.lit("").alias("event_date")))
    want = hits.filter("event_date <> ''").count()
    assert 50 < want < 200
    hits.write.parquet(f"{tmp_path}/hits")
    hits = spark.read.parquet(f"{tmp_path}/hits")
    found = known_among(spark, lake, ["1"], hits, ["event_id"])
    plan_text = found._jdf.queryExecution().executedPlan().toString()
    assert plan_text.count("PartitionFilters: [isnotnull(run_id") == 0 and "Exchange hashpartitioning(id_hash" not in plan_text
    # Bytes that the process has asked the system for.
    pid = spark._jvm.java.lang.ProcessHandle.current().pid()

    def read_so_far():
        with open(f"/proc/{pid}/io") as f:
            return int(f.readline().split()[1])

    before = read_so_far()
    assert found.count() == want
    read = read_so_far() - before
    assert read < 0.2 * size, (read, size)


def test_many_hits_choose_folders_only(spark, tmp_path):
    lake = str(tmp_path / "lake")
    ids = spark.range(3000).select(F.concat(F.lit("e"), "id").alias("event_id"), F.lit("d").alias("event_date"))
    for run_id, slots in (("1", 7), ("2", 300)):
        write_seen(ids.filter(f"pmod(hash(event_id), 2) = {run_id} - 1"), lake, run_id, slots)
    seen = read_seen(spark, lake, ["1", "2"])
    hits = ids.withColumn("id_hash", F.xxhash64("event_id"))
    for some in (hits.limit(2), hits.filter("id_hash > 9000000000000000000"), hits, hits.limit(0)):
        for most in (0, 5, 5000):
            left = narrowed(seen, some, most)
            assert rows(left.join(some, "event_id", "left_semi"), "event_id") == rows(some, "event_id")
    few = narrowed(seen, hits.filter("id_hash > 9000000000000000000"), 0)
    assert 0 < few.count() < 1000


def test_ids_of_many_small_runs_are_merged(spark, tmp_path):
    """However few runs there were, no run has to open many folders of ids."""
    lake, behind = str(tmp_path / "lake"), []
    for i in range(4):
        put(tmp_path, key(f"{i}.json.gz"), log(event(f"e{i}"), event(f"e{i + 1}")))
        m = run(spark, tmp_path, id_buckets=4, most_id_folders=8)
        assert (m["events_written"], m["events_duplicate"]) == ((1, 1) if i else (2, 0))
        behind.append(len(seen_segments(spark, lake, [r for _, r in committed_runs(spark, lake)])[1]))
    assert behind == [1, 2, 0, 1]


def test_hours_of_few_events_are_written_by_several_tasks(spark, tmp_path):
    hours = [F.lit(v).alias(c) for c, v in zip(ROUTE[:-1], ("000000000001", "r", "2024", "01", "01"))]
    events = spark.range(200).select(F.col("id").cast("string").alias("raw"), *hours,
                                     F.lpad((F.col("id") % 20).cast("string"), 2, "0").alias("hour"))
    write_events(events, f"{tmp_path}/out", count=200)
    found = [f for _, _, files in os.walk(f"{tmp_path}/out") for f in files if f.startswith("part-")]
    # One file an hour, its task in its name.
    assert len(found) == 20 and len({f[:10] for f in found}) > 2
    assert spark.read.text(f"{tmp_path}/out").count() == 200


def test_steps_at_once(spark):
    """All have ended when one's failure is raised; they keep the caller's job group."""
    sc, ended = spark.sparkContext, []
    sc.setLocalProperty("spark.jobGroup.id", "mine")
    try:
        assert at_once(spark, lambda: spark.range(3).count(), lambda: sc.getLocalProperty("spark.jobGroup.id")) == [3, "mine"]
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    with pytest.raises(ZeroDivisionError):
        at_once(spark, lambda: 1 / 0, lambda: ended.append(spark.range(2).count()))
    assert ended == [2]


def test_bytes_of_a_run_do_not_grow(spark, tmp_path):
    """Ids and sketches that a run writes are its own, and layers stay few."""
    lake, sizes = str(tmp_path / "lake"), []
    for i in range(7):
        put(tmp_path, key(f"{i}.json.gz"), log(*[event(f"e{j}") for j in range(20 * i, 20 * i + 25)]))
        m = run(spark, tmp_path, bloom_items=60, compact_every=4)
        assert (m["events_written"], m["events_duplicate"]) == ((25, 0) if not i else (20, 5))
        last = committed_runs(spark, lake)[-1][1]
        sizes.append(sum(os.path.getsize(os.path.join(d, f)) for t in ("seen", "bloom") for d, _, files
                         in os.walk(f"{lake}/{t}/run_id={last}") for f in files))
    assert max(sizes) < 1.5 * sizes[1]
    layers = known_layers(spark, lake, [r for _, r in committed_runs(spark, lake)], 60, 0.001)
    assert [(x.items, x.added) for x in layers] == [(240, 145)]


def test_a_paused_writer_commits_nothing(spark, tmp_path, monkeypatch):
    """Its claim runs out while it sleeps; another makes the run, and each event is there once."""
    put(tmp_path, key("1.json.gz"), log(event("a"), event("b")))
    write, woken = plan.write_metrics, []

    def pause(*args):
        if not woken:
            woken.append(1)
            assert run(spark, tmp_path, claim_hours=0)["events_written"] == 2
        return write(*args)

    monkeypatch.setattr(plan, "write_metrics", pause)
    with pytest.raises(Claimed):
        run(spark, tmp_path)
    monkeypatch.undo()
    lake = str(tmp_path / "lake")
    assert values(spark, tmp_path) == [event("a"), event("b")]
    assert len(committed_runs(spark, lake)) == 1 == read_metrics(spark, lake).count()
    assert all(len(os.listdir(f"{lake}/{t}")) == 1 for t in ("events", "seen", "metrics", "checkpoints"))


def test_a_living_claim_is_renewed(spark, tmp_path):
    lake = str(tmp_path / "lake")
    with claimed(spark, lake, 1, 2 / 3600) as lease:
        time.sleep(3.5)
        with pytest.raises(Claimed):
            with claimed(spark, lake, 1, 2 / 3600):
                pass
        lease.commit("x")
    with claimed(spark, lake, 1, 1) as other:
        with pytest.raises(Claimed):
            other.commit("y")
    assert committed_runs(spark, lake) == [(1, "x")]


def test_listing_in_chunks(spark, tmp_path, monkeypatch):
    """A thousand files in a hundred folders, of which few are held at a time; later runs list the new ones."""
    names = [f"2024/{m:02d}/{d:02d}/{n}.json.gz" for m in range(1, 6) for d in range(1, 21) for n in range(10)]
    for n in names:
        put(tmp_path, key(n, region=f"r{int(n[5:7]) % 3}"), "")
    put(tmp_path, key("top.json.gz", region="r3"), "")
    put(tmp_path, key("2024/01/x.json.gz", region="r0", account="000000000002"), "")
    held = []
    one = listing._list_folders

    def counted(spark_, trail, rank, options_, suffix, folders):
        found = one(spark_, trail, rank, options_, suffix, folders)
        held.append((len(folders), found.count()))
        return found

    monkeypatch.setattr(listing, "_list_folders", counted)
    few = options(tmp_path, list_folders=8)
    found = list_objects(spark, [TRAIL, Trail("second", "b", "")], few)
    want = sorted([key(n, region=f"r{int(n[5:7]) % 3}") for n in names]
                  + [key("top.json.gz", region="r3"), key("2024/01/x.json.gz", region="r0", account="000000000002")])
    assert [k for k, in rows(found.filter("trail_rank = 0"), "key")] == want == [k for k, in rows(found.filter("trail_rank = 1"), "key")]
    assert max(n for n, _ in held) <= 8 and max(n for _, n in held) <= 80 and len(held) >= 26
    last = spark.createDataFrame([("b", "", "000000000001", "r0", key("2024/03/19/9.json.gz", region="r0"))],
                                 "bucket string, prefix string, account_id string, region string, last_processed_key string")
    left = [k for k, in rows(list_objects(spark, [TRAIL], few, after=last), "key") if "/r0/2024/03" in k and "000000000001" in k]
    assert left == [key(f"2024/03/{d}/{n}.json.gz", region="r0") for d in (19, 20) for n in range(10)]


def test_merged_hours_read_back_equal_in_full_files(spark, tmp_path):
    """Twenty runs bring events of one hour and some of others; readers see each event once at any time."""
    lake = str(tmp_path / "lake")
    for i in range(20):
        put(tmp_path, key(f"{i:02d}.json.gz"), log(
            *[event(f"e{i}-{j}") for j in range(i % 3 + 1)],
            event(f"f{i}", account=f"00000000000{i % 2 + 2}", time="2024-01-02T00:00:00Z", region="" if i % 2 else "r")))
    m = run(spark, tmp_path, max_files=4, events_per_file=7)
    before = values(spark, tmp_path)
    assert len(before) == m["events_written"] == 59
    few = options(tmp_path, events_per_file=7)
    cold = F.col("day") < "02"
    assert merge_hours(spark, lake, few, cold) == 1
    assert values(spark, tmp_path) == before
    sizes = sorted(rows(event_files(spark, lake).filter(cold), "rows"))
    assert sizes == [(4,)] + [(7,)] * 5
    # Another run, then the rest; what the first merge replaced is dropped only now.
    first = next(r for _, r in committed_runs(spark, lake))
    old = f"{lake}/events/run_id={first}/account_id=000000000001"
    assert os.path.exists(old)
    put(tmp_path, key("20.json.gz"), log(event("more"), event("e0-0")))
    assert run(spark, tmp_path, events_per_file=7)["events_written"] == 1
    assert merge_hours(spark, lake, few) == 3
    assert not any(f for _, _, f in os.walk(old))
    assert values(spark, tmp_path) == sorted([*before, event("more")])
    assert merge_hours(spark, lake, few) == 0
    for r in event_files(spark, lake).groupBy("account_id", "region", "day").agg(
            F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("files")).collect():
        assert r.files == -(-r.rows // 7)


def test_reading_one_account_lists_no_other(spark, tmp_path):
    for a in "123":
        put(tmp_path, key("1.json.gz", account=f"00000000000{a}"), log(*[event(f"{a}{i}", account=f"00000000000{a}") for i in range(3)]))
    run(spark, tmp_path)
    one = read_events(spark, str(tmp_path / "lake"), where=F.col("account_id") == "000000000002")
    assert rows(one, "value") == [(event(f"2{i}", account="000000000002"),) for i in range(3)]
    assert all("account_id=000000000002" in f for f in one.inputFiles()) and one.inputFiles()
    location = one._jdf.queryExecution().optimizedPlan().toString()
    assert "000000000001" not in location
    assert read_events(spark, str(tmp_path / "lake"), where=F.lit(False)).count() == 0


def test_a_merge_that_fails_changes_nothing(spark, tmp_path, monkeypatch):
    lake = str(tmp_path / "lake")
    for i in range(3):
        put(tmp_path, key(f"{i}.json.gz"), log(event(f"e{i}")))
    run(spark, tmp_path, max_files=1)
    monkeypatch.setattr(sink_events, "write_manifest", lambda *_: sink_events.Written(0, 0, 0))
    with pytest.raises(RuntimeError, match="wrote 0 of 3"):
        merge_hours(spark, lake)
    monkeypatch.undo()
    assert values(spark, tmp_path) == [event(f"e{i}") for i in range(3)]
    assert merge_hours(spark, lake) == 1 and len(os.listdir(f"{lake}/merge_commits")) >= 1
    assert values(spark, tmp_path) == [event(f"e{i}") for i in range(3)]


def test_a_batch_run_tells_its_progress(spark, tmp_path, caplog):
    for i in range(4):
        put(tmp_path, key(f"{i}.json.gz"), log(*[event(f"e{i}-{j}") for j in range(50)]))
    with caplog.at_level("INFO", "auditlake.progress"):
        run(spark, tmp_path, progress_seconds=0.5)
    lines = [json.loads(r.message) for r in caplog.records]
    assert len(lines) > 2 and lines[-1]["state"] == "done"
    assert all(a["tasks_done"] <= b["tasks_done"] and a["jobs"] <= b["jobs"] for a, b in zip(lines, lines[1:]))
    assert lines[0]["tasks_done"] < lines[-2]["tasks_done"] <= lines[-1]["tasks"]
    assert (lines[-1]["files"], lines[-1]["events"], lines[-1]["step"]) == (4, 200, "state")
    assert spark.sparkContext.getLocalProperty("spark.jobGroup.id") is None


def listed(spark, tmp_path, **changes):
    opts = options(tmp_path, listing="offsets", retry_seconds=0, **changes)
    return drained(lambda: stream_ingest(spark, [TRAIL], str(tmp_path / "lake"), str(tmp_path / "state"), opts, once=True))


def test_listing_offsets(spark, tmp_path):
    """Late keys, new pairs and equal times, a few files in each batch; then nothing new."""
    for i, name in enumerate("5364"):
        path = put(tmp_path, key(f"2024/01/0{name}/x.json.gz"), log(event(name)))
        os.utime(path, (1_700_000_000 + 10 * (i // 2),) * 2)
    put(tmp_path, key("flat.json.gz", region="other"), log(event("flat")))
    assert listed(spark, tmp_path, max_files=2) == 5
    assert listed(spark, tmp_path, max_files=2) == 0
    put(tmp_path, key("2024/01/05/late.json.gz"), log(event("late"), event("5")))
    put(tmp_path, key("2024/01/01/too-late.json.gz"), log(event("too late")))
    put(tmp_path, key("1.json.gz", account="000000000009"), log(event("account")))
    put(tmp_path, key("early.json.gz", region="other"), log(event("early")))
    assert listed(spark, tmp_path, max_files=2) == 3
    assert values(spark, tmp_path) == sorted(event(i) for i in ("5", "3", "6", "4", "flat", "late", "account", "early"))


def test_a_stream_goes_on_behind_a_batch(spark, tmp_path):
    put(tmp_path, key("2024/01/01/1.json.gz"), log(event("a")))
    put(tmp_path, key("2024/01/09/2.json.gz", org="o-1", account="000000000002"), log(event("b")))
    run(spark, tmp_path)
    offset = objects.offset_of(read_checkpoints(spark, str(tmp_path / "lake")), [TRAIL])
    assert offset["last"] == {"0:000000000001/CloudTrail/us-east-1": "2024/01/01/1.json.gz",
                              "0:o-1/000000000002/CloudTrail/us-east-1": "2024/01/09/2.json.gz"}
    put(tmp_path, key("2024/01/01/3.json.gz"), log(event("c"), event("a")))
    listed(spark, tmp_path)
    assert values(spark, tmp_path) == [event(i) for i in "abc"]


def test_only_folders_behind_the_last_keys_are_asked(tmp_path):
    for day in range(1, 29):
        for region in ("r1", "r2"):
            put(tmp_path, key(f"2024/02/{day:02d}/x.json.gz", region=region), "")
    root = str(tmp_path / "b" / "AWSLogs")
    reader = objects.ObjectReader([root], 2, 1000, objects.START)
    rows_, offset = reader.read(objects.START)
    assert len(list(rows_)) == 56 and len(offset["recent"]) == 56
    reader.listing.asked.clear()
    rows_, same = reader.read(offset)
    assert list(rows_) == [] and same == offset
    # Root and the regions of the account; of each region itself, year, month and the days of the look-back.
    assert sorted(f.split("CloudTrail/")[-1] for f in reader.listing.asked if "2024/02/" in f) == [
        f"{r}/2024/02/{d}" for r in ("r1", "r2") for d in (26, 27, 28)]
    assert len(reader.listing.asked) == 2 + 2 * (1 + 1 + 1 + 3)
    # Made again, a batch has what it had, and nothing that came later.
    path = put(tmp_path, key("2024/02/28/y.json.gz", region="r1"), "")
    again = [r[1] for r in reader.readBetweenOffsets(objects.START, offset)]
    assert len(again) == 56 and path not in again
    rows_, later = reader.read(offset)
    assert [r[1] for r in rows_] == [path] and path in later["recent"]


def test_where_a_declarative_stream_stands(spark, tmp_path):
    state, some = str(tmp_path / "state"), options(tmp_path)
    assert stream_checkpoints(spark, state, [TRAIL], some).count() == 0
    for i in range(14):
        put(tmp_path, key(f"{i:02d} +%.json.gz", region=f"r{i % 2}"), log(event(f"e{i // 2}"), event("a")))
        if i % 3 == 2 or i == 13:
            files = stream_log_files(spark, str(tmp_path / "b"), 1)
            stream_write(stream_dedup(stream_events(files)), f"{tmp_path}/out", state, once=True).awaitTermination()
            pairs = stream_checkpoints(spark, state, [TRAIL], some)
            assert rows(pairs, "region", "last_processed_key", "files_processed") == [
                (f"r{r}", key(f"{j:02d} +%.json.gz", region=f"r{r}"), j // 2 + 1) for r in (0, 1) for j in [i - (i - r) % 2]]
    # A batch that began and did not commit does not count.
    os.remove(tmp_path / "state" / "commits" / str(last_batch(spark, state)))
    assert stream_files(spark, state).count() == 13
    held = {r.operator_id: r.state_rows for r in stream_state(spark, state).collect()}
    assert len(held) == 2 and min(held.values()) == 8


def test_runs_are_read_by_days_and_a_sink_by_its_log(spark, tmp_path):
    put(tmp_path, key("1.json.gz"), log(event("a"), event("b", region="r [x]*{1}"), event("c", time="2024-01-03T01:02:03Z"),
                                        event("d", time="2024-01-03T02:02:03Z"), event("e", account="2%3A")))
    run(spark, tmp_path)
    lake = str(tmp_path / "lake")
    (_, done), = committed_runs(spark, lake)
    # The two hours of one day are one folder.
    days = sources_events._day_folders(spark, lake, f"run_id={done}")
    assert len(days) == 4 and all(d.rsplit("/", 1)[1].startswith("day=") for d in days)
    assert len(rows(read_events(spark, lake), "value")) == 5
    stream_write(stream_events(stream_log_files(spark, f"{tmp_path}/b")), f"{lake}2/events/run_id=1", f"{tmp_path}/state2",
                 once=True).awaitTermination()
    assert sources_events._day_folders(spark, f"{lake}2", "run_id=1") == ["run_id=1"]
    assert len(rows(read_events(spark, f"{lake}2", ["1"]), "value")) == 5


def test_files_without_new_events_are_opened_once(spark, tmp_path, monkeypatch):
    asked, opened = [], plan.opened

    def counted(session, files):
        asked.append(sorted(r.key.rsplit("/", 1)[1] for r in files.select("key").collect()))
        return opened(session, files)

    monkeypatch.setattr(plan, "opened", counted)
    put(tmp_path, key("1.json.gz"), log(event("a"), event("b")))
    run(spark, tmp_path)
    # 2 and 3 bring what was written before, 5 a copy of what 4 brings first.
    for name, ids in (("2", "a"), ("3", "ab"), ("4", "bc"), ("5", "ca")):
        put(tmp_path, key(f"{name}.json.gz"), log(*[event(i) for i in ids]))
    run(spark, tmp_path)
    put(tmp_path, key("6.json.gz"), log(event("c")))
    run(spark, tmp_path)
    assert asked == [["1.json.gz"], [f"{i}.json.gz" for i in range(2, 6)], ["4.json.gz"], ["6.json.gz"], []]
    assert values(spark, tmp_path) == sorted([event("a"), event("b"), event("c")])


def test_paths_go_to_the_reader_as_one_text(spark, tmp_path, monkeypatch):
    names = ["a b.json.gz", "c,d.json.gz", "e\nf.json.gz", "ü%20.json.gz"]
    paths = [put(tmp_path, key(n), log(event(n))) for n in names]
    sent, convert = [], ListConverter.convert
    monkeypatch.setattr(ListConverter, "convert", lambda self, items, client: sent.extend(items) or convert(self, items, client))
    found = rows(read_log_files(spark, [f"file:{p}" for p in paths]).select("path"), "path")
    assert len(found) == 4 and not any(str(x).startswith("file:") for x in sent)
    assert rows(read_log_files(spark, []), "path") == []


def test_a_stream_has_few_parts_of_state(spark, tmp_path):
    put(tmp_path, key("1.json.gz"), log(event("a"), event("a")))
    before = spark.conf.get(SHUFFLE_PARTS)
    spark.conf.set(SHUFFLE_PARTS, DEFAULT_PARTS)
    try:
        state = f"{tmp_path}/state"
        events = stream_dedup(stream_events(stream_log_files(spark, f"{tmp_path}/b")))
        stream_write(events, f"{tmp_path}/lake/events/run_id=1", state, once=True).awaitTermination()
        assert spark.conf.get(SHUFFLE_PARTS) == DEFAULT_PARTS
    finally:
        spark.conf.set(SHUFFLE_PARTS, before)
    parts = spark.read.format("state-metadata").load(state).select("numPartitions").distinct().collect()
    assert [r[0] for r in parts] == [max(STATE_PARTS * spark.sparkContext.defaultParallelism, LEAST_STATE_PARTS)]
    assert read_events(spark, f"{tmp_path}/lake", ["1"]).count() == 1


def test_a_few_tasks_list_many_files(spark, tmp_path):
    for i in range(100):
        put(tmp_path, key(f"{i}.json.gz"), log(event(str(i))))
    spark.conf.unset(LISTING_TASKS)
    tracker, before = spark.sparkContext.statusTracker(), LISTERS * spark.sparkContext.defaultParallelism
    spark.sparkContext.setJobGroup("few", "few")
    try:
        files = list_objects(spark, [TRAIL], options(tmp_path)).select("path", F.lit(0).alias("file_no"))
        assert plan.opened(spark, files).count() == 100
        stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("few") for s in tracker.getJobInfo(j).stageIds]
        assert max(s.numTasks for s in stages if s is not None) <= before < 100
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_walk_asks_no_file_of_a_folder_of_files(spark, tmp_path):
    for i in range(20):
        put(tmp_path, key(f"2024/01/{i}.json.gz"), log(event(str(i))))

    class Counted:
        """The files of a folder; how many were asked for."""
        def __init__(self, found):
            self.found = found

        def __iter__(self):
            for s in self.found:
                asked.append(s)
                yield s

    asked, walk = [], Walk(spark, TRAIL, options(tmp_path))
    listed, walk._listed = walk._listed, lambda folder: Counted(listed(folder))
    assert [f.rsplit("us-east-1/", 1)[1] for f in walk.folders()] == ["2024/01"]
    # Account, region, year and month, and one of the files.
    assert len(asked) == 5
