"""Ranked lexical search with per-term geometric blocking.

Documents are cut into terms once, and reduced to the counts of the terms that some item asks for. Each
task then takes its documents in shards of bounded size and indexes them: a term's posting list is
clustered by the similarity of the documents (their vectors of term impacts, as random projections), and
each block of a cluster keeps a summary, the greatest impact of any of its documents for each term.

Terms are in order of falling weight. An item goes through its terms in this order. A document that holds
an earlier term was met in that term's list, so the bound of a block is the product of its summary and the
item's weights from this term on. A block is opened only if its bound reaches the score of the item's last
place so far; then its documents are scored in full, on integers. The sum of the greatest impacts of whole
lists bounds all that is left, and ends an item early. Bounds are exact, so no document is lost.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_folder
from .common import checkpointed

TOP = 20
#: Documents of a block, about.
BLOCK = 32
#: Blocks opened before the bounds are looked at again.
OPENED = 8
#: Impacts in the matrix of one shard: 64 MB.
ELEMENTS = 1 << 24
SHARD = 4096
#: Terms that a block of items may have together; more items make more blocks, each a pass over the documents.
MAX_TERMS = 1 << 14
#: A text is cut into terms in windows of so many bytes.
WINDOW = 1 << 20
PROJECTIONS = 16
#: Rows of one item that meet in a task at the end: at most so many times `top`.
SALTS = 32

_SPLIT = bytes(i if i >= 128 or chr(i).isalnum() else 32 for i in range(256))
_COUNTED = "doc_id long, no_id boolean, n long, terms array<int>, counts array<long>"


def terms_of(text: str | None) -> Iterator[list[bytes]]:
    """The terms of a text in order, window by window."""
    # Lower case of bytes is that of A-Z only; all bytes of other characters are 128 or above.
    data = (text or "").encode("utf-8", "replace").lower().translate(_SPLIT)
    at = 0
    while at < len(data):
        end = len(data) if len(data) - at <= WINDOW else data.rfind(b" ", at, at + WINDOW)
        if end <= at:
            end = data.find(b" ", at + WINDOW)
            end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end + 1


def counted(text: str | None, place: dict[bytes, int]) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of terms of a text, and numbers and counts of those in `place`."""
    n, found = 0, []
    for words in terms_of(text):
        n += len(words)
        known = [place[w] for w in words if w in place]
        if known:
            found.append(np.unique(known, return_counts=True))
    if len(found) == 1:
        return n, *found[0]
    total: dict[int, int] = {}
    for ids, counts in found:
        for i, c in zip(ids.tolist(), counts.tolist()):
            total[i] = total.get(i, 0) + c
    ids = np.array(sorted(total), np.int64)
    return n, ids, np.array([total[i] for i in ids.tolist()], np.int64)


# Items

def _item_terms(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    @F.pandas_udf("array<struct<term:binary,n:long>>")
    def run(texts: pd.Series) -> pd.Series:
        out = []
        for t in texts:
            total: dict[bytes, int] = {}
            for words in terms_of(t):
                for w in words:
                    total[w] = total.get(w, 0) + 1
            out.append([{"term": w, "n": c} for w, c in total.items()])
        return pd.Series(out)
    return items.select(F.col(item_col).alias("item_id"), run(F.col(text_col).cast("string")).alias("terms"))


def _blocks(items: DataFrame, max_terms: int) -> Iterator[list]:
    """The items in blocks with at most `max_terms` distinct terms, or of one item."""
    block, terms = [], set()
    for row in items.toLocalIterator():
        mine = {bytes(t.term) for t in row.terms}
        if block and len(terms | mine) > max_terms:
            yield block
            block, terms = [], set()
        block.append(row)
        terms |= mine
    if block:
        yield block


# A shard

class Shard:
    """The index of some documents: `flat` has (document, term, impact) of all postings."""

    def __init__(self, docs: int, rows: np.ndarray, cols: np.ndarray, impacts: np.ndarray,
                 weights: np.ndarray, later: dict[int, np.ndarray], projection: np.ndarray):
        self.matrix = np.zeros((docs, len(weights)), np.int32)
        self.matrix[rows, cols] = impacts
        self.most = self.matrix.max(axis=0).astype(np.int64) if docs else np.zeros(len(weights), np.int64)
        order = np.argsort(cols, kind="stable")
        self.rows, self.starts = rows[order], np.searchsorted(cols[order], np.arange(len(weights) + 1))
        self.later, self.lists = later, {}
        seen = self.matrix * weights.astype(np.float32)
        length = np.sqrt(np.einsum("ij,ij->i", seen, seen))
        self.place = (seen @ projection) / np.maximum(length, 1e-9)[:, None]

    def blocks(self, term: int):
        """Documents of a term in order of blocks, starts of the blocks, the terms of the summaries, and
        the summaries. Made when the first item comes to the list."""
        if term not in self.lists:
            docs = self.rows[self.starts[term]:self.starts[term + 1]]
            starts = np.zeros(1, np.int64)
            if len(docs) > BLOCK:
                heads = docs[:: BLOCK]
                nearest = (self.place[docs] @ self.place[heads].T).argmax(axis=1)
                order = np.argsort(nearest, kind="stable")
                docs, nearest = docs[order], nearest[order]
                first = np.searchsorted(nearest, nearest)
                starts = np.flatnonzero((np.arange(len(docs)) - first) % (2 * BLOCK) == 0)
            terms = self.later[term]
            self.lists[term] = docs, np.append(starts, len(docs)), terms, np.maximum.reduceat(
                self.matrix[np.ix_(docs, terms)], starts, axis=0)
        return self.lists[term]

    def search(self, terms: np.ndarray, weights: np.ndarray, found: "Found") -> None:
        """Put the best documents of an item (terms in order) into `found`."""
        rest = np.cumsum((weights * self.most[terms])[::-1])[::-1]
        met = np.zeros(len(self.matrix), bool)
        # Whole numbers below 2**53 are exact as doubles, and much faster to multiply.
        kind = np.float64 if len(rest) and float(rest[0]) < 2 ** 53 else np.int64
        times = weights.astype(kind)
        for i, term in enumerate(terms.tolist()):
            if rest[i] < found.least:
                return
            if self.starts[term] == self.starts[term + 1]:
                continue
            docs, starts, known, summary = self.blocks(term)
            bound = summary[:, np.searchsorted(known, terms[i:])].astype(kind) @ times[i:]
            order = np.argsort(-bound, kind="stable")
            for at in range(0, len(order), OPENED):
                some = order[at:at + OPENED]
                some = some[bound[some] >= found.least]
                if not len(some):
                    break
                rows = np.concatenate([docs[starts[b]:starts[b + 1]] for b in some.tolist()])
                rows = rows[~met[rows]]
                met[rows] = True
                if len(rows):
                    found.add(rows, (self.matrix[np.ix_(rows, terms)].astype(kind) @ times).astype(np.int64))


class Found:
    """The best documents of one item so far; `least` is the score that a further one needs."""

    def __init__(self, top: int):
        self.top, self.least = top, 1
        self.scores, self.no_id, self.ids = np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)

    def of(self, ids: np.ndarray, no_id: np.ndarray) -> "Found":
        """Takes documents by their row in a shard from now on."""
        self.names = ids, no_id
        return self

    def add(self, rows: np.ndarray, scores: np.ndarray) -> None:
        good = scores >= self.least
        rows = rows[good]
        scores = np.concatenate([self.scores, scores[good]])
        no_id = np.concatenate([self.no_id, self.names[1][rows]])
        ids = np.concatenate([self.ids, self.names[0][rows]])
        best = np.lexsort((ids, no_id, -scores))[:self.top]
        self.scores, self.no_id, self.ids = scores[best], no_id[best], ids[best]
        if len(best) == self.top:
            self.least = max(1, int(self.scores[-1]))


class Asked:
    """A block of items as numbers: terms in order of falling weight, their weights, and for each term
    those that come later in any of its items."""

    def __init__(self, place: dict[bytes, int], items: list, documents: int, length: int, held: dict[int, int]):
        self.documents, self.length = documents, length
        df = np.array([held.get(i, 0) for i in range(len(place))], np.float64)
        # A term no document holds asks for nothing.
        weight = np.where(df > 0, np.floor(1000 * np.log((2.0 * documents + 2) / (2 * df + 1))), 0).astype(np.int64)
        order = np.argsort(-weight, kind="stable")
        self.number = np.empty(len(place), np.int64)
        self.number[order] = np.arange(len(place))
        self.weights = weight[order]
        self.items, later = [], {}
        for row in items:
            mine = sorted((int(self.number[place[bytes(t.term)]]), t.n) for t in row.terms)
            terms = np.array([t for t, _ in mine], np.int64)
            self.items.append((terms, self.weights[terms] * np.array([n for _, n in mine], np.int64)))
            for i, t in enumerate(terms.tolist()):
                later.setdefault(t, set()).update(terms[i:].tolist())
        self.later = {t: np.array(sorted(x), np.int64) for t, x in later.items()}

    def impacts(self, counts: np.ndarray, n: np.ndarray) -> np.ndarray:
        m = 100 - 25 + (25 * n * self.documents) // max(self.length, 1)
        return (1_000_000_000 * counts) // (1000 * counts + 12 * m)


def _search(asked, top: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        a: Asked = asked.value
        found = [Found(top) for _ in a.items]
        size = max(16, min(SHARD, ELEMENTS // max(1, len(a.weights))))
        projection = np.random.default_rng(5).normal(size=(len(a.weights), PROJECTIONS)).astype(np.float32)
        for batch in batches:
            for at in range(0, len(batch), size):
                part = batch.iloc[at:at + size]
                sizes = part["terms"].map(len).to_numpy(np.int64)
                rows = np.repeat(np.arange(len(part)), sizes)
                cols = a.number[np.concatenate(part["terms"].tolist())]
                counts = np.concatenate(part["counts"].tolist()).astype(np.int64)
                impacts = a.impacts(counts, np.repeat(part["n"].to_numpy(np.int64), sizes))
                shard = Shard(len(part), rows, cols, impacts, a.weights, a.later, projection)
                names = part["doc_id"].to_numpy(np.int64), part["no_id"].to_numpy(bool)
                for (terms, weights), f in zip(a.items, found):
                    shard.search(terms, weights, f.of(*names))
        for i, f in enumerate(found):
            yield pd.DataFrame({"item": i, "doc_id": f.ids, "no_id": f.no_id, "score": f.scores})
    return run


def _counted(docs: DataFrame, id_col: str, text_col: str, place) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = place.value
        for batch in batches:
            n, terms, counts = zip(*[counted(t, known) for t in batch["text"]])
            yield pd.DataFrame({"doc_id": batch["doc_id"], "no_id": batch["no_id"], "n": n, "terms": terms, "counts": counts})

    doc_id = F.col(id_col).cast("long")
    return docs.select(F.coalesce(doc_id, F.lit(0)).alias("doc_id"), doc_id.isNull().alias("no_id"),
                       F.col(text_col).cast("string").alias("text")).mapInPandas(run, _COUNTED)


def _search_block(spark: SparkSession, docs: DataFrame, block: list, id_col: str, text_col: str, item_type, top: int) -> DataFrame:
    place = {t: i for i, t in enumerate(sorted({bytes(t.term) for row in block for t in row.terms}))}
    with scratch_folder(spark, "postings") as path:
        _counted(docs, id_col, text_col, spark.sparkContext.broadcast(place)).write.parquet(path)
        rows = spark.read.schema(_COUNTED).parquet(path)
        documents, length = rows.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        # One row for each term of the items.
        held = dict(rows.select(F.explode("terms").alias("term")).groupBy("term").count().collect())
        asked = spark.sparkContext.broadcast(Asked(place, block, documents, length, held))
        local = rows.filter(F.size("terms") > 0).mapInPandas(
            _search(asked, top), "item int, doc_id long, no_id boolean, score long")
        order = [F.desc("score"), "no_id", "doc_id"]
        salted = local.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
        first = salted.withColumn("rank", F.row_number().over(Window.partitionBy("item", "salt").orderBy(*order)))
        best = (first.filter(F.col("rank") <= top).drop("rank")
                .withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order)))
                .filter(F.col("rank") <= top))
        names = spark.createDataFrame([(i, row.item_id) for i, row in enumerate(block)], f"item int, item_id {item_type}")
        return checkpointed(best.join(F.broadcast(names), "item").select(
            "item_id", "rank", F.when(~F.col("no_id"), F.col("doc_id")).alias("doc_id"), "score"))


def lexical_search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   item_col: str = "item_id", item_text_col: str = "text", top: int = TOP,
                   max_terms: int = MAX_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the `top` documents of each item with a score above 0.

    Null and empty texts have no terms: such documents are not counted, such items find nothing. Texts
    of any length are read whole, window by window. Repeated rows are documents (and items) of their own;
    equal scores are in order of doc_id, rows without an id behind. Other columns are not looked at. An
    empty table on either side gives no rows. The search runs when this is called.
    """
    spark = docs.sparkSession
    item_type = items.schema[item_col].dataType.simpleString()
    found = None
    for block in _blocks(_item_terms(items, item_col, item_text_col), max_terms):
        part = _search_block(spark, docs, block, id_col, text_col, item_type, top)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], f"item_id {item_type}, rank int, doc_id long, score long")
    return found
