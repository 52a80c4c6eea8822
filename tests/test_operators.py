"""Dedup, joins, numbering, checkpoints and sketch against brute force."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from auditlake.operators import (advance_checkpoints, assign_file_no, bloom_build, bloom_merge, bloom_probe,
                                 bloom_size, checkpoint_marks, dedup_first, drop_seen, mark_duplicates,
                                 merge_checkpoints, pending_objects)
from auditlake.operators.skew import hot_keys, lookup_join, salted_join
from auditlake.schemas import CHECKPOINT, PAIR

from helpers import rows

PLACE = ("trail_rank", "key", "ordinal")


@pytest.fixture(scope="module")
def records():
    """A third of all rows has one id, another part none."""
    rnd = random.Random(7)
    out = []
    for i in range(3000):
        event_id = "hot" if i % 3 == 0 else "" if i % 10 == 1 else f"id{rnd.randrange(1200)}"
        out.append((event_id, rnd.randrange(2), f"k{rnd.randrange(50):02d}", i, f"raw{i}"))
    return out


@pytest.fixture(scope="module")
def frame(spark, records):
    return spark.createDataFrame(
        records, "event_id string, trail_rank int, key string, ordinal int, raw string").repartition(6)


def winners(records):
    first = {}
    for r in records:
        if r[0] not in first or r[1:4] < first[r[0]][1:4]:
            first[r[0]] = r
    return first


def test_dedup_first(frame, records):
    expect = winners(records)
    got = dedup_first(frame)
    assert rows(got, "event_id", "raw") == sorted((r[0], r[4]) for r in expect.values())
    assert got.agg(F.sum("copies")).first()[0] == len(records)
    assert set(got.columns) == {*frame.columns, "copies"}


def test_dedup_may_keep_records_without_id(frame, records):
    missing = sum(r[0] == "" for r in records)
    got = dedup_first(frame, keep_missing_ids=True)
    assert got.count() == len(winners(records)) - 1 + missing
    assert got.filter("event_id = ''").count() == missing


@pytest.mark.parametrize("min_rows", [1, 100, 10**9])
def test_mark_duplicates(frame, records, min_rows):
    expect = {r[4] for r in winners(records).values()}
    got = mark_duplicates(frame, min_rows=min_rows).collect()
    assert len(got) == len(records)
    assert {r.raw for r in got if not r.is_duplicate} == expect


@pytest.mark.parametrize("min_rows", [1, 100, 10**9])
@pytest.mark.parametrize("known", [["hot", "id1", "id2", "else"], [""], []])
def test_drop_seen(spark, frame, records, known, min_rows):
    seen = spark.createDataFrame([(k,) for k in known], "event_id string")
    got = drop_seen(frame, seen, min_rows=min_rows)
    assert rows(got, "raw") == sorted((r[4],) for r in records if r[0] not in known)


def test_two_thousand_hot_ids_are_all_split(spark):
    frame = spark.range(40_000).select((F.col("id") % 2000).cast("string").alias("event_id"), F.col("id").alias("ordinal"))
    counts = frame.groupBy("event_id").agg(F.count("*").alias("copies"))
    hot = hot_keys(counts, ["event_id"], min_rows=5)
    assert hot.count() == 2000 and {r["_salts"] for r in hot.collect()} == {5}
    joined = salted_join(frame, counts, ["event_id"], "inner", hot, ["ordinal"])
    assert joined.count() == 40_000 and joined.filter("copies <> 20").count() == 0


def test_hot_keys_are_split(spark, frame):
    counts = frame.groupBy("event_id").agg(F.count("*").alias("copies"))
    hot = hot_keys(counts, ["event_id"], min_rows=300)
    assert hot.count() == counts.filter("copies >= 300").count() > 0
    ids = counts.select("event_id", F.lit(1).alias("there"))
    joined = salted_join(frame, ids, ["event_id"], "inner", hot, ["key", "ordinal"])
    assert joined.count() == frame.count()
    assert joined.columns == ["event_id", "trail_rank", "key", "ordinal", "raw", "there"]


@pytest.mark.parametrize("max_rows", [0, 10])
def test_lookup_join_both_ways(spark, max_rows):
    left = spark.createDataFrame([(i % 4, f"k{i}") for i in range(100)], "a int, key string")
    lookup = spark.createDataFrame([(0, "x"), (1, "y")], "a int, v string")
    got = lookup_join(left, lookup, ["a"], ["key"], max_rows=max_rows)
    assert rows(got.filter("v is not null"), "key", "v") == sorted(
        (f"k{i}", "xy"[i % 4]) for i in range(100) if i % 4 < 2)
    assert got.count() == 100


def test_file_numbers(spark, frame, records):
    events = frame.withColumns({
        "account_id": F.lit("a"), "region": F.when(F.col("event_id") == "hot", "").otherwise("r"),
        "year": F.lit("2024"), "month": F.lit("01"), "day": F.lit("01"), "hour": F.lit("05"),
        # One busy second.
        "event_time": F.lit("2024-01-01T05:06:07Z"), "event_micros": F.lit(1704085567000000)})
    per_file = defaultdict(int)
    numbers = defaultdict(set)
    got = assign_file_no(events, 100).collect()
    assert len(got) == len(records)
    for r in got:
        per_file[r.region, r.file_no] += 1
        numbers[r.region].add(r.file_no)
        assert r.file_name == "events_%05d.jsonl" % r.file_no
    for region, n in numbers.items():
        size = sum(v for (reg, _), v in per_file.items() if reg == region)
        assert n == set(range(-(-size // 100)))
        assert all(per_file[region, i] == 100 for i in range(size // 100))
    in_order = sorted(got, key=lambda r: (r.region, r.file_no))
    for a, b in zip(in_order, in_order[1:]):
        assert a.region != b.region or a.file_no == b.file_no or a.event_id <= b.event_id


def listing(spark, counts):
    data = [("b", "", a, "r", f"AWSLogs/{a}/CloudTrail/r/{i:05d}.json.gz") for a, n in counts.items() for i in range(n)]
    random.Random(3).shuffle(data)
    return spark.createDataFrame(data, "bucket string, prefix string, account_id string, region string, key string")


def test_marks_and_commits_agree(spark):
    counts = {"hot": 1234, "exact": 200, "few": 7, "one": 1}
    objects = listing(spark, counts)
    marks = defaultdict(list)
    for r in checkpoint_marks(objects).collect():
        marks[r.account_id].append((r.file_no, r.key[-13:-8], r.is_last))
    advanced = {r.account_id: r for r in advance_checkpoints(objects).collect()}
    for a, n in counts.items():
        numbers = sorted({*range(100, n + 1, 100), n})
        assert sorted(marks[a]) == [(i, f"{i - 1:05d}", i == n) for i in numbers]
        assert advanced[a].commits == n // 100 + 1 and advanced[a].files_processed == n
        assert advanced[a].last_processed_key.endswith(f"{n - 1:05d}.json.gz")


@pytest.mark.parametrize("max_lookup_rows", [0, 100])
def test_pending_is_what_sorts_after(spark, max_lookup_rows):
    objects = listing(spark, {"x": 30, "y": 5})
    old = spark.createDataFrame([("b", "", "x", "r", "AWSLogs/x/CloudTrail/r/00009.json.gz", 10, 1, None),
                                 ("b", "other", "y", "r", "zzz", 1, 1, None)], CHECKPOINT)
    got = pending_objects(objects, old, max_lookup_rows)
    assert rows(got.groupBy("account_id").count()) == [("x", 20), ("y", 5)]
    empty = spark.createDataFrame([("b", "", "x", "r", None, 0, 0, None)], CHECKPOINT)
    assert pending_objects(objects, empty, max_lookup_rows).count() == 35
    merged = merge_checkpoints(old, advance_checkpoints(got))
    assert rows(merged, *PAIR, "files_processed", "commits") == [
        ("b", "", "x", "r", 30, 2), ("b", "", "y", "r", 5, 1), ("b", "other", "y", "r", 1, 1)]


def test_keys_compare_by_bytes(spark):
    keys = ["a/Z", "a/a", "a/é", "a/\U0001F600", "a/￮", "a/Z0"]
    df = spark.createDataFrame([("b", "", "x", "r", k) for k in keys],
                               "bucket string, prefix string, account_id string, region string, key string")
    for last in keys:
        old = spark.createDataFrame([("b", "", "x", "r", last, 1, 1, None)], CHECKPOINT)
        assert {k for k, in rows(pending_objects(df, old), "key")} == {k for k in keys if k.encode() > last.encode()}


def test_sketch_size_follows_the_formula():
    size = bloom_size(100_000_000, 0.001)
    assert size.hashes == 10
    assert abs(size.blocks * 32768 / 1_437_758_757 - 1) < 1e-4


@pytest.mark.parametrize("limit", [0, 10**9])
def test_sketch(spark, limit):
    items, fpp = 20_000, 0.01
    a = spark.range(0, 12_000).selectExpr("concat('id', id) as event_id")
    b = spark.range(8_000, 20_000).selectExpr("concat('id', id) as event_id")
    sketch = bloom_merge(bloom_build(a, items, fpp), bloom_build(b.union(b), items, fpp))
    assert sketch.count() <= bloom_size(items, fpp).blocks
    probe = spark.range(0, 60_000).selectExpr(
        "concat('id', id) as event_id", "0 as trail_rank", "'k' as key", "id as ordinal")
    hits = bloom_probe(probe, sketch, items, fpp, max_broadcast_bytes=limit).filter("maybe_seen")
    assert hits.filter("ordinal < 20000").count() == 20_000
    assert hits.filter("ordinal >= 20000").count() < 0.02 * 40_000


def test_empty_sketch_knows_nothing(spark, frame):
    sketch = bloom_build(frame.limit(0), 1000, 0.01)
    assert bloom_probe(frame, sketch, 1000, 0.01).filter("maybe_seen").count() == 0
