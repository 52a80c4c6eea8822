"""Hard-negative mining with STR-packed R-trees.

Rows are packed sort-tile-recursively: cut in slabs by one coordinate, each slab in tiles by a second
one (a range partitioning, with a hash behind it so that equal vectors are split too), and within the
task of a tile by further coordinates, down to leaves. A node keeps the minimum bounding box of its rows,
their labels as one more interval. A box gives for each coordinate the interval of its products with the
anchor's, and their sum an interval that holds all inner products with rows of the box.

A search pops boxes from a queue, highest possible score first, and drops those outside the score window,
those without a fitting label, and those whose highest score is strictly below the k-th found (an equal
score can win by its id). An anchor asks its own tile first; what it finds there is a floor for all other
tiles. All arithmetic is on integers (as doubles while they are exact).

An anchor's positives are the first rows of its label. Each positive opens a window of scores, in which
the anchor's negatives are searched, for all its positives in one walk through a tree.
"""

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed

POSITIVES, NEGATIVES = 5, 3
#: A negative's score in hundredths of the positive's, both ends in it.
LOW, HIGH = 50, 95
SCALE = 256
#: Rows of a tile, about, of a leaf, and nodes below a node.
TILE, LEAF, FAN = 8192, 128, 8
#: Anchors that meet a tile in one task.
ASKS = 4096
#: Components of this magnitude or more (after scaling) have products that need not fit a long.
TOO_LARGE = 1 << 26
#: Rows from which the coordinates to pack by are chosen.
SAMPLE = 4096


def usable(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
           scale: int = SCALE) -> DataFrame:
    """(vec_id, label, vector, dims) of rows that take part, the vector as whole numbers."""
    vector = F.col("vector")
    good = (rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"),
                        F.col(vector_col).cast("array<double>").alias("vector"))
            .filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & vector.isNotNull()
                    & F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < TOO_LARGE // scale))))
    whole = good.withColumn("vector", F.transform("vector", lambda x: F.floor(scale * x)))
    one = whole.groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("row"))
    return one.select("vec_id", "row.label", "row.vector", F.size("row.vector").alias("dims"))


def tiles(rows: DataFrame, tile: int = TILE) -> DataFrame:
    """`rows` with `tile`: slabs of the coordinate that varies most, in each of them ranges of the next one."""
    rows = checkpointed(rows)
    n = rows.count()
    count = max(1, -(-n // tile))
    if count == 1:
        return rows.withColumn("tile", F.lit(0))
    draw = F.pmod(F.xxhash64("vec_id"), F.lit(1_000_003)) / 1_000_003.0
    drawn = rows.filter(draw < SAMPLE / n).select(F.posexplode("vector").alias("at", "x"))
    spread = drawn.groupBy("at").agg(F.variance("x").alias("v")).orderBy(F.desc_nulls_last("v"), "at").limit(2).collect()
    first, second = (F.coalesce(F.get("vector", F.lit(s.at)), F.lit(0)) for s in (*spread, *spread[-1:])[:2]) if spread else (F.lit(0),) * 2
    slabs = max(1, round(count ** 0.5))
    cuts = rows.select(F.percentile_approx(first, [i / slabs for i in range(1, slabs)] or [1.0])).first()[0]
    slab = F.size(F.filter(F.array(*[F.lit(int(c)) for c in cuts]), lambda c: c < first))
    return checkpointed(rows.withColumn("slab", slab).withColumn("second", second).withColumn("mix", F.xxhash64("vec_id"))
                        .repartitionByRange(count, "dims", "slab", "second", "mix")
                        .withColumn("tile", F.spark_partition_id()).drop("slab", "second", "mix"))


# One tree

def str_order(x: np.ndarray, leaf: int) -> np.ndarray:
    """The order of rows that packs them in leaves: slabs by one coordinate, these again by the next."""
    if not len(x):
        return np.zeros(0, np.int64)
    axes = np.argsort(-x.var(axis=0), kind="stable")[:3].tolist()

    def pack(rows: np.ndarray, axes: list[int]) -> list[np.ndarray]:
        if not axes or len(rows) <= leaf:
            return [rows]
        rows = rows[np.argsort(x[rows, axes[0]], kind="stable")]
        slabs = max(1, round((len(rows) / leaf) ** (1 / len(axes))))
        step = -(-len(rows) // slabs)
        step = -(-step // leaf) * leaf
        return [p for at in range(0, len(rows), step) for p in pack(rows[at:at + step], axes[1:])]

    return np.concatenate(pack(np.arange(len(x)), axes))


class Tree:
    """An R-tree over rows of one length. Nodes are numbered from the leaves up; the last is the root."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, leaf: int = LEAF, fan: int = FAN):
        # Sums of products below 2**53 are exact as doubles.
        most = np.abs(vectors).max(initial=0)
        self.kind = np.float64 if float(most) * TOO_LARGE * max(1, vectors.shape[1]) < 2 ** 53 else np.int64
        order = str_order(vectors, leaf)
        self.ids, self.labels, self.vectors = ids[order], labels[order], vectors[order].astype(self.kind)
        starts = np.arange(0, len(ids), leaf)
        self.spans = [(int(a), int(min(a + leaf, len(ids)))) for a in starts]
        self.leaves = len(starts)
        bounds = [np.minimum.reduceat(self.vectors, starts), np.maximum.reduceat(self.vectors, starts),
                  np.minimum.reduceat(self.labels, starts), np.maximum.reduceat(self.labels, starts)]
        level, first = bounds, 0
        while len(level[0]) > 1:
            n = len(level[0])
            starts = np.arange(0, n, fan)
            level = [f.reduceat(b, starts) for f, b in zip((np.minimum, np.maximum) * 2, level)]
            self.spans += [(first + int(a), first + int(min(a + fan, n))) for a in starts]
            bounds = [np.concatenate([b, x]) for b, x in zip(bounds, level)]
            first += n
        self.low, self.high, self.label_low, self.label_high = bounds

    def intervals(self, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lowest and highest possible score of each asked vector (rows) with each box (columns)."""
        up, down = np.maximum(asked, 0), np.minimum(asked, 0)
        return up @ self.low.T + down @ self.high.T, up @ self.high.T + down @ self.low.T

    def search(self, asked: np.ndarray, anchors: np.ndarray, labels: np.ndarray, same: bool, windows: list, top: int):
        """(number of the asked, window, id, score) of the best `top` rows in each of its windows.

        A window is (low, high, floor); scores below low or floor, or above high, do not count. `same`
        asks for other rows of the same label, else rows of another label are meant.
        """
        asked = asked.astype(self.kind)
        low, high = self.intervals(asked)
        out = []
        for i in range(len(asked)):
            label, best = labels[i], [[] for _ in windows[i]]
            # Of each window: the least score still wanted, and the highest.
            least = [max(w[0], w[2]) for w in windows[i]]
            most = [w[1] for w in windows[i]]
            ceiling = max(most, default=-np.inf)
            fits = ((self.label_low <= label) & (label <= self.label_high) if same
                    else (self.label_low != label) | (self.label_high != label))
            mine_low, mine_high = low[i].tolist(), high[i].tolist()
            queue = [(-min(mine_high[-1], ceiling), len(self.spans) - 1)] if fits[-1] else []
            while queue:
                bound, node = heapq.heappop(queue)
                if -bound < min(least):
                    break
                if not any(mine_high[node] >= a and mine_low[node] <= b for a, b in zip(least, most)):
                    continue
                a, b = self.spans[node]
                if node >= self.leaves:
                    for child in range(a, b):
                        if fits[child] and mine_high[child] >= min(least) and mine_low[child] <= ceiling:
                            heapq.heappush(queue, (-min(mine_high[child], ceiling), child))
                    continue
                score = self.vectors[a:b] @ asked[i]
                ok = (self.labels[a:b] == label) & (self.ids[a:b] != anchors[i]) if same else self.labels[a:b] != label
                for w, kept in enumerate(best):
                    rows = np.flatnonzero(ok & (score >= least[w]) & (score <= most[w]))
                    if len(rows):
                        kept += zip((-score[rows]).tolist(), self.ids[a:b][rows].tolist())
                        kept.sort()
                        del kept[top:]
                        if len(kept) == top:
                            least[w] = max(least[w], -kept[-1][0])
            out += [(i, w, vec_id, int(-s)) for w, kept in enumerate(best) for s, vec_id in kept]
        return out


# The search over all tiles

_FOUND = "anchor_id long, window int, vec_id long, score long"


def _visit(same: bool, top: int):
    def run(rows: pd.DataFrame, asks: pd.DataFrame) -> pd.DataFrame:
        found = []
        for dims, asking in asks.groupby("dims"):
            have = rows[rows["dims"] == dims]
            if not len(have):
                continue
            def matrix(column):
                return np.array(column.tolist(), np.int64).reshape(len(column), int(dims))
            tree = Tree(have["vec_id"].to_numpy(), have["label"].to_numpy(), matrix(have["vector"]))
            windows = [[(w["low"], w["high"], w["floor"]) for w in some] for some in asking["windows"]]
            anchors = asking["anchor_id"].to_numpy()
            for i, w, vec_id, score in tree.search(matrix(asking["vector"]), anchors, asking["label"].to_numpy(), same, windows, top):
                found.append((int(anchors[i]), w, vec_id, score))
        return pd.DataFrame(found, columns=["anchor_id", "window", "vec_id", "score"])
    return run


def _best(found: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("anchor_id", "window").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def search(index: DataFrame, asks: DataFrame, same: bool, top: int, block: int = ASKS) -> DataFrame:
    """(anchor_id, window, rank, vec_id, score): the best rows of `index` in each window of each ask.

    `asks` are (anchor_id, label, vector, dims, tile, windows), the tile being the anchor's own. Each tile
    meets all asks, in blocks, in a task of their own.
    """
    sizes = asks.groupBy("tile").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    # At home: a tile and the anchors in it.
    mine = F.pmod(F.xxhash64("anchor_id"), F.col("blocks")).cast("int").alias("block")
    here = asks.join(sizes, "tile").select(*asks.columns, mine)
    copies = index.join(sizes, "tile").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
    run = _visit(same, top)
    home = checkpointed(copies.groupBy("tile", "block").cogroup(here.groupBy("tile", "block")).applyInPandas(run, _FOUND))
    # Their last place is a floor elsewhere.
    floors = (_best(home, top).filter(F.col("rank") == top).groupBy("anchor_id")
              .agg(F.map_from_entries(F.collect_list(F.struct("window", "score"))).alias("floors")))
    raised = asks.join(floors, "anchor_id", "left").withColumn("windows", F.transform(
        "windows", lambda w, i: F.struct(w.low.alias("low"), w.high.alias("high"),
                                         F.coalesce(F.try_element_at("floors", i), w.floor).alias("floor")))).drop("floors")
    # Every block of anchors goes to every other tile: tile numbers run from 0.
    last, asked = index.agg(F.coalesce(F.max("tile"), F.lit(0))).first()[0], asks.count()
    blocks = max(1, -(-asked // block))
    away = (raised.withColumn("block", F.pmod(F.xxhash64("anchor_id"), F.lit(blocks)).cast("int"))
            .withColumnRenamed("tile", "own").withColumn("tile", F.explode(F.sequence(F.lit(0), F.lit(last))))
            .filter(F.col("tile") != F.col("own")).drop("own"))
    spread = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    rest = spread.groupBy("tile", "block").cogroup(away.groupBy("tile", "block")).applyInPandas(run, _FOUND)
    return _best(home.unionByName(rest), top)


def hard_negatives(rows: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   low: int = LOW, high: int = HIGH, tile: int = TILE, block: int = ASKS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for `rows` as `usable`
    gives them; `is_anchor` is a condition on vec_id and label.

    The positives of an anchor are the first rows of its label, and for each the first rows of other
    labels with low * positive <= 100 * negative <= high * positive are returned. Higher scores come
    first, ties by smaller id. Only vectors of one length are compared. An anchor without positives, or
    whose windows are empty, has no rows, and neither has an empty table.

    Of rows with a null id, label or vector, with a component that is null, not finite or 2**18 or more
    in size (see `usable`), none take part; of several rows with one id the smallest label and vector
    count. Other columns are not looked at.
    """
    index = tiles(rows, tile)
    # Named anew, as both sides of the search come from one table.
    anchors = index.filter(is_anchor).select(F.col("vec_id").alias("anchor_id"), *[
        F.col(c).alias(c) for c in ("label", "vector", "dims", "tile")])
    least, most = F.lit(-2 ** 62).cast("long"), F.lit(2 ** 62).cast("long")

    def window(low_end, high_end):
        return F.struct(low_end.alias("low"), high_end.alias("high"), least.alias("floor"))

    asks = anchors.withColumn("windows", F.array(window(least, most)))
    chosen = checkpointed(search(index, asks, True, positives, block).select(
        "anchor_id", F.col("rank").alias("place"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")))
    # The whole scores of a window; decimals, since the products may pass a long.
    exact = "cast(positive_score AS decimal(20,0))"
    ends = window(F.expr(f"({exact} * {low} + 99) div 100"), F.expr(f"{exact} * {high} div 100"))
    by_anchor = (chosen.filter(F.col("positive_score") >= 0).groupBy("anchor_id")
                 .agg(F.sort_array(F.collect_list(F.struct("place", ends.alias("w")))).alias("some")))
    asks = anchors.join(by_anchor, "anchor_id").withColumn("windows", F.transform("some", lambda x: x.w)).drop("some")
    # A window's number is the place of its positive, since places run from 1 and scores only fall.
    found = search(index, asks, False, negatives, block).withColumn("place", F.col("window") + 1)
    return found.join(chosen, ["anchor_id", "place"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))
