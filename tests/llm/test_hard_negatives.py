import numpy as np
import pytest

from auditlake.llm import hard_negatives as hn

F = hn.F


def table(spark, rows, extra=""):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int" + extra).repartition(3)


def slow(rows, is_anchor):
    """All pairs of {vec_id: (label, whole vector)}."""
    out = []
    for a, (label, v) in rows.items():
        if not is_anchor(a):
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, other) for i, (other, w) in rows.items()
                        if i != a and len(w) == len(v))
        for s, p, _ in [x for x in scored if x[2] == label][:5]:
            fit = [(n, -t) for t, n, other in scored if other != label and 50 * -s <= 100 * -t <= 95 * -s]
            out += [(a, p, r + 1, n, -s, t) for r, (n, t) in enumerate(fit[:3])]
    return sorted(out)


def found(frame):
    return sorted(tuple(r[c] for c in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
                  for r in frame.collect())


def whole(vectors):
    return [[int(np.floor(256 * x)) for x in v] for v in vectors]


@pytest.mark.parametrize("tile,block,clusters", [(10_000, 4096, 0), (60, 7, 0), (60, 5, 8)])
def test_against_all_pairs(spark, tile, block, clusters):
    rng = np.random.default_rng(tile + clusters)
    x = rng.normal(size=(500, 6))
    if clusters:
        x = 0.2 * x + rng.normal(size=(clusters, 6))[rng.integers(clusters, size=500)]
    x[100:160] = x[100]
    labels = rng.integers(0, 4, 500).tolist()
    rows = hn.usable(table(spark, [(i, v.tolist(), lab) for i, (v, lab) in enumerate(zip(x, labels))]))
    got = found(hn.hard_negatives(rows, F.col("vec_id") % 10 == 0, tile=tile, block=block))
    want = slow({i: (labels[i], v) for i, v in enumerate(whole(x))}, lambda i: i % 10 == 0)
    assert len(want) > 100 and got == want


def test_tiles_are_even_though_vectors_are_equal(spark):
    rows = hn.usable(table(spark, [(i, [1.0, 2.0] if i % 3 else [float(i), -float(i)], 0) for i in range(3000)]))
    sizes = [r["count"] for r in hn.tiles(rows, 300).groupBy("tile").count().collect()]
    assert sum(sizes) == 3000 and max(sizes) < 900


def test_boxes_hold_all_scores_and_prune():
    rng = np.random.default_rng(2)
    vectors = (rng.integers(-20, 20, (12, 5))[rng.integers(12, size=2000)] * 50 + rng.integers(-9, 10, (2000, 5)))
    labels = rng.integers(0, 3, 2000)
    tree = hn.Tree(np.arange(2000), labels, vectors, leaf=32, fan=4)
    asked = rng.integers(-900, 900, (20, 5))
    low, high = tree.intervals(asked.astype(tree.kind))
    rows = {}

    def below(node):
        a, b = tree.spans[node]
        if node < tree.leaves:
            return list(range(a, b))
        return [r for child in range(a, b) for r in below(child)]

    for node in range(len(tree.spans)):
        rows[node] = below(node)
        score = asked @ tree.vectors[rows[node]].T
        assert (low[:, node] <= score.min(axis=1)).all() and (score.max(axis=1) <= high[:, node]).all()
    assert sorted(rows[len(tree.spans) - 1]) == list(range(2000))
    # Leaves that cannot hold the best five stay closed: far fewer scores than rows are looked at.
    looked = []

    class Looking(np.ndarray):
        def __matmul__(self, other):
            looked.append(len(self))
            return np.asarray(self) @ other

    tree.vectors = tree.vectors.view(Looking)
    got = tree.search(asked, np.full(20, -1), np.zeros(20, int), True, [[(-2 ** 62, 2 ** 62, -2 ** 62)]] * 20, 5)
    for i in range(20):
        want = sorted((-int(asked[i] @ v), r) for r, v in enumerate(vectors.tolist()) if labels[r] == 0)[:5]
        assert [(-s, r) for j, _, r, s in got if j == i] == want
    assert sum(looked) < 0.4 * 2000 * 20


def test_rows_that_take_no_part(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, [1.0, 0.0], 1), (1, [0.9, 0.0], 1), (2, [0.7, 0.1], 2), (3, [0.7, 0.1], None), (4, None, 2), (5, [0.7, None], 2),
            (6, [0.7, nan], 2), (8, [0.7, inf], 2), (None, [0.7, 0.1], 2), (9, [0.7, 0.1, 0.0], 2), (10, [], 2), (11, [1e300, 0.0], 2),
            (2, [0.7, 0.1], 2), (12, [-1.0, 0.0], 1), (13, [0.7, 0.1], 3)]
    frame = table(spark, [(*r, 0, "x") for r in rows], ", tile int, dims string")
    got = found(hn.hard_negatives(hn.usable(frame), F.col("vec_id") == 0))
    want = slow({0: (1, [256, 0]), 1: (1, [230, 0]), 2: (2, [179, 25]), 12: (1, [-256, 0]), 13: (3, [179, 25])}, lambda i: i == 0)
    assert got == want and [r[3] for r in got] == [2, 13]


def test_zero_and_empty_vectors(spark):
    rows = [(0, [0.0], 1), (1, [0.0], 1), (2, [5.0], 2), (20, [], 1), (21, [], 1), (22, [], 2)]
    got = found(hn.hard_negatives(hn.usable(table(spark, rows)), F.col("vec_id") % 20 == 0))
    assert got == [(0, 1, 1, 2, 0, 0), (20, 21, 1, 22, 0, 0)]


def test_large_numbers_are_exact(spark):
    rng = np.random.default_rng(7)
    x = rng.uniform(-1, 1, (80, 40)) * 2 ** 17.9
    rows = [(i, v.tolist(), i % 2) for i, v in enumerate(x)]
    got = found(hn.hard_negatives(hn.usable(table(spark, rows)), F.col("vec_id") % 5 == 0))
    assert got == slow({i: (i % 2, v) for i, v in enumerate(whole(x))}, lambda i: i % 5 == 0)


def test_empty_table(spark):
    assert hn.hard_negatives(hn.usable(table(spark, [])), F.col("vec_id") % 50 == 0).count() == 0
