import numpy as np
import pytest

from auditlake.llm import neighbours as nb


def table(spark, vectors, ids=None, extra=""):
    ids = range(len(vectors)) if ids is None else ids
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v], 0) for i, v in zip(ids, vectors)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)


def slow(ids, vectors, query_ids, top=20):
    out = {}
    for q in query_ids:
        have = [(-float(sum(a * b for a, b in zip(vectors[q], vectors[i]))), i) for i in ids if i != q]
        out[q] = [(i, -s) for s, i in sorted(have)[:top]]
    return out


def as_lists(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        assert r.rank == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


def test_one_partition_is_exact_with_ties(spark):
    rng = np.random.default_rng(1)
    base = rng.integers(-3, 4, (20, 6)).astype(float)
    vectors = {i: base[rng.integers(20)] for i in range(0, 400, 2)}
    vectors = {i: v for i, v in vectors.items() if v.any()}
    frame = table(spark, list(vectors.values()), list(vectors))
    got = as_lists(nb.nearest_neighbours(frame, nb.F.col("vec_id") % 20 == 0).collect())
    assert got == slow(list(vectors), vectors, [i for i in vectors if i % 20 == 0])


def test_small_blocks_give_the_same(spark):
    rng = np.random.default_rng(2)
    vectors = dict(enumerate(rng.normal(size=(150, 5))))
    rows = nb.usable(table(spark, list(vectors.values())))
    got = as_lists(nb.search(rows, nb.F.col("vec_id") % 3 == 0, nb.fit(rows), top=7, block=20).collect())
    want = slow(list(vectors), vectors, range(0, 150, 3), 7)
    assert {q: [i for i, _ in x] for q, x in got.items()} == {q: [i for i, _ in x] for q, x in want.items()}


@pytest.mark.parametrize("clusters", [0, 40])
def test_recall_and_probes(spark, monkeypatch, clusters):
    """At least 0.9 of the neighbours; few partitions are asked where the vectors have structure."""
    monkeypatch.setattr(nb, "PARTITION_ROWS", 400)
    rng = np.random.default_rng(3)
    x = rng.normal(size=(4000, 24))
    if clusters:
        x = x * 0.25 + rng.normal(size=(clusters, 24))[rng.integers(clusters, size=4000)]
    rows = nb.usable(table(spark, x))
    parts = nb.fit(rows)
    assert parts.count == 16
    if clusters:
        assert parts.probes <= 6
    got = as_lists(nb.search(rows, nb.F.col("vec_id") % 20 == 0, parts).collect())
    hits = 0
    for q in range(0, 4000, 20):
        score = x @ x[q]
        score[q] = -np.inf
        hits += len({i for i, _ in got[q]} & set(np.argsort(-score)[:20].tolist()))
    assert hits / (200 * 20) >= 0.9


def test_parts_are_balanced_and_cut_little():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(800, 8)) * 0.1 + np.eye(8)[rng.integers(8, size=800)]
    heads, tails = nb.neighbour_graph(x / np.linalg.norm(x, axis=1, keepdims=True))
    part = nb.balanced_parts(heads, tails, 800, 3)
    assert np.bincount(part).tolist() == [100] * 8
    shuffled = rng.permutation(part)
    assert (part[heads] != part[tails]).sum() < 0.5 * (shuffled[heads] != shuffled[tails]).sum()


def test_equal_vectors_share_a_partition():
    rng = np.random.default_rng(5)
    x = np.repeat(rng.normal(size=(500, 8)), 3, axis=0)
    parts = nb.Partitions(x, 10**6)
    assert parts.count > 1
    for size in (1, 7, 1500):
        same = np.concatenate([parts.assign(x[a:a + size]) for a in range(0, 1500, size)])
        assert (same == parts.assign(x)).all()


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [[1, 2], [0, 0], None, [], [nan, 1], [inf, 1], [None, 1], [1, 2, 3], [2, 1], [2, 1], [-1, 0], [0, 1]]
    ids = [0, 20, 40, 60, 80, 100, 120, 140, 160, 160, 3, None]
    got = as_lists(nb.nearest_neighbours(table(spark, vectors, ids), nb.F.col("vec_id") % 20 == 0).collect())
    assert got == {0: [(160, 4.0), (3, -1.0)], 160: [(0, 4.0), (3, -2.0)]}
    empty = table(spark, [[1.0]]).limit(0)
    assert nb.nearest_neighbours(empty, nb.F.col("vec_id") % 20 == 0).count() == 0
    assert nb.nearest_neighbours(table(spark, [[1.0]]), nb.F.lit(True)).count() == 0


def made(cls, **values):
    """An object with these attributes and nothing learned."""
    out = object.__new__(cls)
    out.__dict__.update(values)
    return out


def test_small_partitions_do_not_cut_the_result(spark):
    """Two partitions by length of the vectors; all queries are sent to the one that holds two rows."""
    rng = np.random.default_rng(8)
    vectors = dict(enumerate(rng.normal(size=(60, 4))))
    vectors[7][0] = vectors[20][0] = 500.0
    by_length = [np.array([[0.0]] * 4 + [[1.0]]), np.array([-4.0]), np.array([[10.0, 0.0]]), np.array([0.0, 1.0])]
    always = [np.zeros((5, 1)), np.zeros(1), np.zeros((1, 2)), np.array([3.0, 0.0])]
    parts = made(nb.Partitions, count=2, probes=1, assigner=made(nb.Classifier, w=by_length), router=made(nb.Classifier, w=always))
    assert parts.assign(np.array([vectors[i] for i in (7, 8, 20)])).tolist() == [0, 1, 0]
    got = as_lists(nb.search(nb.usable(table(spark, list(vectors.values()))), nb.F.col("vec_id") % 20 == 0, parts).collect())
    want = slow(list(vectors), vectors, [0, 20, 40])
    assert {q: [i for i, _ in x] for q, x in got.items()} == {q: [i for i, _ in x] for q, x in want.items()}


def test_many_equal_rows_are_cut_chunk_by_chunk():
    rows = np.ones((5000, 3))
    q, r, s = nb.nearest(rows[:600], np.arange(600), rows, np.arange(5000), 20)
    assert len(q) == 600 * 20 and (s == 3).all()
    assert r[:20].tolist() == list(range(1, 21)) and r[20 * 5:20 * 6].tolist() == [*range(5), *range(6, 21)]
