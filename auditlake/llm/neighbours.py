"""Approximate nearest neighbours by learned partitions.

On a bounded sample, a neighbour graph is cut in two again and again into balanced parts with few
cut edges. A small classifier learns the parts and gives every row its partition. A second one
learns in which partitions the nearest rows of a vector lie, and sends each query to the several
most probable ones, as many as reach `TARGET` of the neighbours of sample vectors it has not seen.
There the rows are reranked by the exact inner product.

Rows are dealt by partition and block and queries by partition and block of queries, so that a task
holds `BLOCK` rows and `BLOCK` queries at most, however full a partition is.
"""

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed

TOP = 20
#: Rows the partitions are learned from, about; drawn by a hash of the id.
SAMPLE = 6000
#: Rows of a partition, about, and the sample rows each partition needs.
PARTITION_ROWS = 4096
ROWS_TO_LEARN = 48
TARGET = 0.95
DEGREE = 12
HIDDEN = 96
BLOCK = 8192
_SEED = 11


# The graph

def neighbour_graph(unit: np.ndarray, degree: int = DEGREE) -> tuple[np.ndarray, np.ndarray]:
    """Edges (i, j), each in both directions, between a row and its nearest by angle."""
    n = len(unit)
    k = min(degree, n - 1)
    pairs = []
    for at in range(0, n, 1024):
        near = unit[at:at + 1024] @ unit.T
        near[np.arange(len(near)), np.arange(at, at + len(near))] = -np.inf
        best = np.argpartition(-near, k - 1, axis=1)[:, :k] if k else np.zeros((len(near), 0), int)
        pairs.append(np.stack([np.repeat(np.arange(at, at + len(near)), k), best.ravel()], axis=1))
    one = np.concatenate(pairs)
    both = np.unique(np.concatenate([one, one[:, ::-1]]), axis=0)
    return both[:, 0], both[:, 1]


def _bisect(heads: np.ndarray, tails: np.ndarray, n: int, rng) -> np.ndarray:
    """Side 0 or 1 of each of n nodes, half of them each: a spectral cut, then swaps that gain."""
    degree = np.maximum(np.bincount(heads, minlength=n), 1)
    trivial = np.sqrt(degree)
    trivial /= np.linalg.norm(trivial)
    scale = 1 / np.sqrt(degree)
    x = rng.normal(size=n)
    for _ in range(60):
        x -= (x @ trivial) * trivial
        x = x + scale * np.bincount(heads, (scale * x)[tails], minlength=n)
        x /= max(np.linalg.norm(x), 1e-12)
    side = np.zeros(n, np.int64)
    side[np.argsort(x * scale, kind="stable")[n // 2:]] = 1
    for _ in range(10):
        other = np.bincount(heads, side[tails] != side[heads], minlength=n)
        gain = 2 * other - np.bincount(heads, minlength=n)
        a, b = (np.flatnonzero(side == s) for s in (0, 1))
        a, b = a[np.argsort(-gain[a], kind="stable")], b[np.argsort(-gain[b], kind="stable")]
        m = min(len(a), len(b))
        worth = int((gain[a[:m]] + gain[b[:m]] > 2).sum())
        if not worth:
            break
        # Only some at a time: the gains of neighbours change with each swap.
        take = max(1, worth // 3)
        before = (side[heads] != side[tails]).sum()
        side[a[:take]], side[b[:take]] = 1, 0
        if (side[heads] != side[tails]).sum() >= before:
            side[a[:take]], side[b[:take]] = 0, 1
            break
    return side


def balanced_parts(heads: np.ndarray, tails: np.ndarray, n: int, levels: int) -> np.ndarray:
    """The part of each node, one of 2**levels; sizes differ by one at each cut."""
    rng = np.random.default_rng(_SEED)
    part = np.zeros(n, np.int64)
    for _ in range(levels):
        after = part * 2
        for p in np.unique(part):
            inside = part == p
            number = np.cumsum(inside) - 1
            own = inside[heads] & inside[tails]
            after[inside] += _bisect(number[heads[own]], number[tails[own]], int(inside.sum()), rng)
        part = after
    return part


# The classifiers

class Classifier:
    """Direction and length of a vector to probabilities of the partitions: one hidden layer."""

    def __init__(self, x: np.ndarray, target: np.ndarray, epochs: int = 120):
        rng = np.random.default_rng(_SEED)
        x = self._features(x)
        self.w = [rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN),
                  rng.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, target.shape[1])), np.zeros(target.shape[1])]
        m, v = [np.zeros_like(w) for w in self.w], [np.zeros_like(w) for w in self.w]
        step, size = 0, 256
        for epoch in range(epochs):
            order = rng.permutation(len(x))
            for at in range(0, len(x), size):
                some = order[at:at + size]
                hidden = np.maximum(x[some] @ self.w[0] + self.w[1], 0)
                error = (self._softmax(hidden @ self.w[2] + self.w[3]) - target[some]) / len(some)
                back = (error @ self.w[2].T) * (hidden > 0)
                grads = [x[some].T @ back, back.sum(0), hidden.T @ error, error.sum(0)]
                step += 1
                rate = 0.004 * (1 - epoch / epochs) + 1e-4
                for i, g in enumerate(grads):
                    g = g + 1e-4 * self.w[i]
                    m[i], v[i] = 0.9 * m[i] + 0.1 * g, 0.999 * v[i] + 0.001 * g * g
                    self.w[i] = self.w[i] - rate * (m[i] / (1 - 0.9 ** step)) / (np.sqrt(v[i] / (1 - 0.999 ** step)) + 1e-8)

    @staticmethod
    def _features(x: np.ndarray) -> np.ndarray:
        size = np.linalg.norm(x, axis=1, keepdims=True)
        return np.hstack([x / size * np.sqrt(x.shape[1]), np.log(size)])

    @staticmethod
    def _softmax(z: np.ndarray) -> np.ndarray:
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        # Row by row the same arithmetic, so that equal vectors get equal partitions.
        hidden = np.maximum(np.einsum("ij,jk->ik", self._features(x), self.w[0]) + self.w[1], 0)
        return self._softmax(np.einsum("ij,jk->ik", hidden, self.w[2]) + self.w[3])


class Partitions:
    """The learned partitions: `count` of them, and how many of them a query `probes`."""

    def __init__(self, sample: np.ndarray, rows: int, target: float = TARGET):
        sample = np.unique(sample, axis=0) if len(sample) else sample
        levels = 0
        while rows > PARTITION_ROWS << levels and len(sample) >= ROWS_TO_LEARN << (levels + 1):
            levels += 1
        self.count, self.probes, self.assigner, self.router = 1 << levels, 1, None, None
        if not levels:
            return
        unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
        part = balanced_parts(*neighbour_graph(unit), len(sample), levels)
        self.assigner = Classifier(sample, np.eye(self.count)[part])
        mine = self.assign(sample)
        hits = np.zeros((len(sample), self.count))
        top = min(TOP, len(sample) - 1)
        for at in range(0, len(sample), 1024):
            score = sample[at:at + 1024] @ sample.T
            score[np.arange(len(score)), np.arange(at, at + len(score))] = -np.inf
            best = np.argpartition(-score, top - 1, axis=1)[:, :top]
            for i, b in enumerate(best):
                hits[at + i] = np.bincount(mine[b], minlength=self.count)
        hits /= top
        unseen = np.random.default_rng(_SEED).random(len(sample)) < 0.25
        self.router = Classifier(sample[~unseen], hits[~unseen])
        order = np.argsort(-self.router.probabilities(sample[unseen]), axis=1)
        reached = np.cumsum(np.take_along_axis(hits[unseen], order, axis=1), axis=1).mean(axis=0)
        self.probes = min(self.count, int(np.searchsorted(reached, target - 1e-9)) + 1)

    def assign(self, x: np.ndarray) -> np.ndarray:
        """The partition of each row."""
        if self.assigner is None or not len(x):
            return np.zeros(len(x), np.int64)
        return self.assigner.probabilities(x).argmax(axis=1)

    def route(self, x: np.ndarray, sizes: np.ndarray, least: int) -> list[np.ndarray]:
        """The most probable partitions of each query, best first: as many as usual, and further ones
        until they have `least` rows together, by the `sizes` of all partitions."""
        if self.router is None or not len(x):
            return [np.zeros(1, np.int64)] * len(x)
        order = np.argsort(-self.router.probabilities(x), axis=1, kind="stable")
        enough = (np.cumsum(sizes[order], axis=1) < least).sum(axis=1) + 1
        return [o[:max(self.probes, n)] for o, n in zip(order, enough.tolist())]


# The search

def inner_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, summed from the first component on, whatever stands beside a row."""
    total = np.zeros(len(a))
    for i in range(a.shape[1]):
        total += a[:, i] * b[:, i]
    return total


def nearest(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, row_ids: np.ndarray, top: int = TOP):
    """(query number, row number, score) of the nearest rows of each query but its own id."""
    found = []
    for at in range(0, len(queries), 256):
        rough = queries[at:at + 256] @ rows.T
        rough[query_ids[at:at + 256, None] == row_ids[None, :]] = -np.inf
        k = min(top, rows.shape[0])
        edge = -np.partition(-rough, k - 1, axis=1)[:, k - 1]
        # Products may differ in the last digits: all near the edge are computed exactly.
        slack = 1e-9 * (np.abs(edge) + np.linalg.norm(queries[at:at + 256], axis=1) * 1e-3 + 1e-300)
        low = np.where(np.isfinite(edge), edge - slack, -np.finfo(float).max)
        q, r = np.nonzero(rough >= low[:, None])
        s = np.concatenate([inner_products(queries[q[x:x + (1 << 18)] + at], rows[r[x:x + (1 << 18)]])
                            for x in range(0, len(q), 1 << 18)] or [np.zeros(0)])
        # Rows may be tied in any number: only the first stay, chunk by chunk.
        order = np.lexsort((row_ids[r], -s, q))
        q, r, s = q[order], r[order], s[order]
        first = np.arange(len(q)) - np.searchsorted(q, q) < top
        found.append((q[first] + at, r[first], s[first]))
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, int), np.zeros(0, int), np.zeros(0))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), dtype=np.float64).reshape(len(column), -1)


def usable(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, vector) of rows with an id and a finite, non-zero vector of the commonest length.

    Of several rows with one id the smallest vector counts.
    """
    vector = F.col("vector")
    good = (rows.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
            .filter(F.col("vec_id").isNotNull() & (F.size(vector) > 0)
                    & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
                    & F.exists(vector, lambda x: x != 0)))
    one = checkpointed(good.groupBy("vec_id").agg(F.min("vector").alias("vector")))
    sizes = one.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return one.filter(F.size("vector") == (sizes[0].n if sizes else 0))


def fit(rows: DataFrame, sample: int = SAMPLE, target: float = TARGET) -> Partitions:
    """Partitions for all `rows` (vec_id, vector), learned from about `sample` of them."""
    n = rows.count()
    draw = F.pmod(F.xxhash64("vec_id"), F.lit(1_000_003)) / 1_000_003.0
    drawn = rows.filter(draw < sample / max(n, 1)).orderBy("vec_id").select("vector").collect()
    return Partitions(np.array([r.vector for r in drawn], dtype=np.float64), n, target)


def search(rows: DataFrame, is_query: Column, partitions: Partitions, top: int = TOP, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score) for `rows` (vec_id, vector): the nearest found of each query."""
    shared = rows.sparkSession.sparkContext.broadcast(partitions)

    @F.pandas_udf("int")
    def assign(vectors: pd.Series) -> pd.Series:
        return pd.Series(shared.value.assign(_matrix(vectors)).astype(np.int32))

    index = checkpointed(rows.withColumn("part", assign("vector")))
    # One number for each partition learned.
    counts = np.zeros(partitions.count, np.int64)
    for part, n in index.groupBy("part").count().collect():
        counts[part] = n

    @F.pandas_udf("array<int>")
    def route(vectors: pd.Series) -> pd.Series:
        # A query may be among the rows itself.
        found = shared.value.route(_matrix(vectors), counts, top + 1)
        return pd.Series([x.astype(np.int32) for x in found])

    asked = checkpointed(rows.filter(is_query).select(F.col("vec_id").alias("query_id"), F.col("vector").alias("query"),
                                                      F.explode(route("vector")).alias("part")))
    # One row for each partition: bounded by the partitions learned.
    sizes = index.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    needs = asked.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("asks"))
    plan = F.broadcast(checkpointed(sizes.join(needs, "part").coalesce(1)))

    def numbered(frame, id_name, own, other):
        """Each row in its own block, once for each block of the other side."""
        mine = F.pmod(F.xxhash64(id_name), F.col(own)).cast("int").alias(own)
        spread = F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(other)
        return (frame.join(plan, "part").select(*frame.columns, mine, spread)
                .groupBy("part", "blocks", "asks"))

    left, right = numbered(index, "vec_id", "blocks", "asks"), numbered(asked, "query_id", "asks", "blocks")

    def compare(have: pd.DataFrame, want: pd.DataFrame) -> pd.DataFrame:
        if not len(have) or not len(want):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        row_ids, query_ids = have["vec_id"].to_numpy(), want["query_id"].to_numpy()
        q, r, s = nearest(_matrix(want["query"]), query_ids, _matrix(have["vector"]), row_ids, top)
        return pd.DataFrame({"query_id": query_ids[q], "vec_id": row_ids[r], "score": s})

    found = left.cogroup(right).applyInPandas(compare, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
            .select("query_id", "rank", "vec_id", "score"))


def nearest_neighbours(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding",
                       top: int = TOP) -> DataFrame:
    """The nearest rows of each query by inner product; `is_query` is a condition on vec_id.

    Vectors that `usable` leaves out neither ask nor are found. An empty table gives no rows.
    """
    rows = usable(vectors, id_col, vector_col)
    return search(rows, is_query, fit(rows), top)
