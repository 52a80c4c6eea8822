import collections
import hashlib
import itertools
import random

import duckdb

from auditlake.llm import oracles, warc


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)


def archived(spark, rows, **options):
    return warc.archive(pages(spark, rows), **options)


def as_set(found):
    return {(r.file, r.offset, r.page_id, r.problem) for r in found.collect()}


def test_records_are_warc(spark):
    text = pages(spark, [(7, "http://a/é", "<p>é\n</p>")]).select(
        warc.record_text(warc.F.col("page_id"), warc.F.col("url"), warc.F.col("html"))).first()[0]
    head, payload, end, _ = text.split("\r\n\r\n")[0], *text.split("\r\n\r\n")[1:], None
    assert head.startswith("WARC/1.1\r\n") and payload == "<p>é\n</p>" and end == ""
    fields = dict(x.split(": ", 1) for x in head.split("\r\n")[1:])
    assert int(fields["Content-Length"]) == len(payload.encode())
    assert fields["WARC-Payload-Digest"] == "sha256:" + hashlib.sha256(payload.encode()).hexdigest()


def test_offsets_are_gapless(spark):
    rng = random.Random(1)
    rows = [(i // 2, f"u{i}", "x" * rng.randrange(50)) for i in range(100)] + [(3, "same", "same")] * 5
    by_file = {}
    for r in archived(spark, rows, file_pages=20).collect():
        by_file.setdefault(r.file, []).append((r.offset, r.length * r.copies))
    assert set(by_file) == {0, 1, 2}
    for records in by_file.values():
        end = 0
        for offset, size in sorted(records):
            assert offset == end
            end += size


def test_only_differing_branches_are_opened(spark):
    rng = random.Random(2)
    rows = [(i, f"u{i}", "x" * rng.randrange(300)) for i in range(2000)]
    bad = list(rows)
    bad[777] = (777, "u777", bad[777][2] + "y")
    bad[778] = (778, "u778", bad[778][2][:0])
    one, two = (archived(spark, r, file_pages=10) for r in (rows, bad))
    found, counts, moved = warc.compare(one, two, least=512, fanout=4)
    assert {(p, x) for _, _, p, x in as_set(found)} == {(777, "altered"), (778, "altered")}
    # What lies behind a record of another length in its file has moved.
    assert {r.page_id for r in moved.collect()} <= {778, 779}
    assert counts[0] == 1 and max(counts) <= 8 and len(counts) >= 5
    same, counts, _ = warc.compare(one, one)
    assert as_set(same) == set() and counts == [0]


def test_against_a_plain_comparison(spark):
    rng = random.Random(3)
    rows = [(rng.randrange(300), f"u{rng.randrange(5)}", "ab"[i % 2] * rng.randrange(200)) for i in range(500)]
    bad = [(p, u, h if rng.random() < 0.95 else h[1:] + "z") for p, u, h in rows if rng.random() < 0.99]
    one, two = (archived(spark, r, file_pages=30) for r in (rows, bad + [(900, "new", None)]))
    found, _, moved = warc.compare(one, two, least=256, fanout=3)

    def by_content(x):
        return {(r.file, r.page_id, r.digest): (r.offset, r.copies) for r in x.collect()}

    a, b = by_content(one), by_content(two)
    left = [collections.defaultdict(list), collections.defaultdict(list)]
    want = set()
    for mine, other, out in ((a, b, left[0]), (b, a, left[1])):
        for (file, page, digest), (offset, copies) in mine.items():
            if (file, page, digest) not in other:
                out[file, page].append(offset)
            elif out is left[0] and copies != other[file, page, digest][1]:
                want.add((file, offset, page, "altered"))
    for file, page in left[0].keys() | left[1].keys():
        for x, y in itertools.zip_longest(sorted(left[0][file, page]), sorted(left[1][file, page])):
            want.add((file, y if x is None else x, page, "missing" if y is None else "added" if x is None else "altered"))
    assert as_set(found) == want and {p for *_, p in want} == {"missing", "added", "altered"}
    assert {(r.file, r.page_id, r.digest) for r in moved.collect()} == {
        k for k in a.keys() & b.keys() if a[k][0] != b[k][0]}


def test_one_lost_record_is_one_finding(spark):
    rows = [(i, "u", "x" * (i * 37 % 301)) for i in range(100)]
    one, two = archived(spark, rows), archived(spark, rows[:40] + rows[41:])
    found, _, moved = warc.compare(one, two, least=128, fanout=4)
    assert [(r.page_id, r.problem) for r in found.collect()] == [(40, "missing")]
    assert sorted(r.page_id for r in moved.collect()) == list(range(41, 100))


def test_many_payloads_without_an_id(spark):
    rows = [(None, "u", f"p{i}") for i in range(300)]
    records = sorted((r.offset, r.length) for r in archived(spark, rows).collect())
    assert all(a + n == b for (a, n), (b, _) in zip(records, records[1:])) and len(records) == 300
    found = warc.compare(archived(spark, rows), archived(spark, rows[:-1])).found
    assert [r.problem for r in found.collect()] == ["missing"]


def test_edges(spark):
    rows = [(None, None, None), (None, "u", ""), (-5, "u", "x"), (10**9, None, "é" * 100000), (1, "u", "h"), (1, "u", "h")]
    one = archived(spark, rows)
    assert warc.compare(one, one)[1] == [0]
    assert len(as_set(warc.compare(one, archived(spark, rows[:-1]))[0])) == 1
    empty = archived(spark, rows).limit(0)
    assert as_set(warc.compare(empty, empty)[0]) == set()
    assert {p for *_, p in as_set(warc.compare(one, empty)[0])} == {"missing"}


def test_query_equals_its_sql(spark):
    from auditlake.llm import queries

    folder = "/root/testdata/sf0.01"
    got = [tuple(r) for r in queries.op4_warc(spark, folder).collect()]
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{folder}/pages.parquet'")
    assert sorted(got, key=str) == sorted(con.execute(oracles.OP4).fetchall(), key=str)
