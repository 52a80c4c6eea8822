import random

import pytest
import xxhash
from pyspark.sql import functions as F

from auditlake.llm import simhash

from .helpers import EDGE_TEXTS, docs, texts


def slow_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", lowered) if w]
    if not words:
        return 0
    parts = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_groups(rows, radius=3):
    """(id, fingerprint, smallest id reachable) by comparing all pairs."""
    prints = [(i, slow_fingerprint(t)) for i, t in rows]
    group = list(range(len(prints)))
    for x in range(len(prints)):
        for y in range(x):
            if (prints[x][1] ^ prints[y][1]).bit_count() <= radius and group[x] != group[y]:
                old, new = group[x], group[y]
                group = [new if g == old else g for g in group]
    out = []
    for k, (i, p) in enumerate(prints):
        ids = [j for g, (j, _) in zip(group, prints) if g == group[k] and j is not None]
        out.append((i, p, min(ids) if ids else None))
    return out


def run(frame, **options):
    return [(r[0], r[1] & (2**64 - 1), r[2]) for r in simhash.simhash_groups(frame, **options).collect()]


def order(rows):
    return sorted(rows, key=str)


def test_fingerprints_of_edge_texts():
    for t in EDGE_TEXTS + ["A b\x0bC\x0cd É e", "x " * 40000]:
        assert simhash.fingerprint(t) == slow_fingerprint(t)


def test_groups_equal_all_pairs(spark):
    rng = random.Random(1)
    base = ["".join(rng.choices("abcdef", k=3)) for _ in range(400)]
    rows = [(i, t) for i, t in enumerate(EDGE_TEXTS)]
    for i in range(20, 220):
        words = base[:] if i % 3 else rng.sample(base, 60)
        for _ in range(rng.randrange(4)):
            words[rng.randrange(len(words))] = "new"
        rows.append((i, " ".join(words)))
    rows += [(300, rows[30][1]), (30, rows[30][1]), (None, rows[40][1]), (None, "alone here")]
    assert order(run(docs(spark, rows))) == order(slow_groups(rows))


@pytest.mark.parametrize("radius", [1, 3])
def test_links_with_small_buckets(spark, radius):
    """Buckets of four at most: every refinement level is used."""
    rng = random.Random(radius)
    seeds = [rng.getrandbits(64) for _ in range(12)]
    prints = {s ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(6))) for s in seeds for _ in range(60)}
    frame = spark.createDataFrame([(simhash._signed(p),) for p in prints], "fp long")
    roots = {r.node: r.root for r in simhash.components(simhash.links(frame, radius, bucket=4)).collect()}
    found = {p: roots.get(simhash._signed(p), simhash._signed(p)) for p in prints}
    for p in prints:
        todo, seen = [p], {p}
        while todo:
            x = todo.pop()
            near = {y for y in prints - seen if (x ^ y).bit_count() <= radius}
            seen |= near
            todo += near
        assert {q for q in prints if found[q] == found[p]} == seen


def test_bit_planes_against_distances():
    rng = random.Random(3)
    for radius in range(8):
        values = [rng.getrandbits(64) & 0xFFFF for _ in range(90)]
        planes = [(b, sum(1 << i for i, v in enumerate(values) if v >> b & 1)) for b in range(64)]
        lanes = simhash.near_lanes(planes, values[0], (1 << 90) - 1, radius)
        assert lanes == sum(1 << i for i, v in enumerate(values) if (v ^ values[0]).bit_count() <= radius)


def test_a_large_group_is_one_component(spark):
    chain = [sum(1 << b for b in range(k)) for k in range(0, 64)]
    frame = spark.createDataFrame([(simhash._signed(p),) for p in chain], "fp long")
    roots = simhash.components(simhash.links(frame)).collect()
    assert len(roots) == 63 and len({r.root for r in roots}) == 1


def test_keep_one_keeps_columns_and_one_row(spark):
    rows = [(5, "a b c d"), (3, "a b c d"), (3, "a b c d"), (None, "a b c d"), (7, "other words are here"),
            (None, "null id alone"), (None, "null id alone"), (9, None), (8, "")]
    frame = docs(spark, rows, ", fp string, key int, FP_ int")
    kept = simhash.keep_one(frame)
    assert kept.columns == frame.columns
    assert sorted((r.doc_id, r.text) for r in kept.collect() if r.doc_id is not None) == [
        (3, "a b c d"), (7, "other words are here"), (8, "")]
    assert [r.text for r in kept.collect() if r.doc_id is None] == ["null id alone"]


def test_empty_table(spark):
    assert run(docs(spark, [])) == []
    assert simhash.keep_one(docs(spark, [])).count() == 0


def test_edge_texts_link_as_fingerprint_zero(spark):
    found = simhash.simhash_groups(texts(spark, EDGE_TEXTS)).filter(F.col("fp") == 0)
    assert {r.component_id for r in found.collect()} == {0}
