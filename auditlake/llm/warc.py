"""WARC records and a Merkle audit of their replicas.

The leaves of a tree are records (file, offset, length, digest). The first level hashes the records
that begin in the same `RANGE` bytes of a file, in the order of their offsets; each further level
hashes `FANOUT` neighbouring ranges, up to the file, and then `FANOUT` neighbouring files, up to one
root. A node has at most `FANOUT` children, and a range no more records than fit in its bytes, so
no group is unbounded. Two replicas are compared from the root down: a level is only looked at below
nodes that differ, and the records below differing ranges are where the damage is.

There, records are aligned by id and digest, so that one lost record is one finding though all behind it
in its file have moved.
"""

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed

RANGE = 1 << 16
FANOUT = 16
FILE_PAGES = 500
CRLF = "\r\n"


# Records

def record_text(record_id: Column, url: Column, payload: Column) -> Column:
    """The record of a fetched page as it stands in a WARC file. Nulls count as empty."""
    payload = F.coalesce(payload.cast("string"), F.lit(""))
    name = F.md5(F.coalesce(record_id.cast("string"), F.lit("")))
    uuid = F.concat_ws("-", name.substr(1, 8), name.substr(9, 4), name.substr(13, 4), name.substr(17, 4),
                       name.substr(21, 12))
    head = F.concat_ws(
        CRLF, F.lit("WARC/1.1"), F.lit("WARC-Type: resource"),
        F.concat(F.lit("WARC-Record-ID: <urn:uuid:"), uuid, F.lit(">")),
        F.concat(F.lit("WARC-Target-URI: "), F.coalesce(url.cast("string"), F.lit(""))),
        F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.sha2(payload, 256)),
        F.lit("Content-Type: text/html"),
        F.concat(F.lit("Content-Length: "), F.octet_length(payload).cast("string")))
    return F.concat(head, F.lit(CRLF * 2), payload, F.lit(CRLF * 2))


def archive(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
            file_pages: int = FILE_PAGES) -> DataFrame:
    """(file, offset, length, copies, digest, page_id): where each page's record lies.

    A file holds `file_pages` consecutive ids, a null id counts as -1; its records are ordered by id
    and digest. Equal records lie behind each other and are one row with their number of copies. The
    running offset of a file is that of its slices (an id and the beginning of a digest), of which it has
    a bounded number, and the one inside the slice; so a file with a third of all rows is no one task.
    """
    page_id = F.coalesce(F.col(id_col).cast("long"), F.lit(-1).cast("long"))
    text = record_text(F.col(id_col), F.col(url_col), F.col(payload_col))
    rows = pages.select(page_id.alias("page_id"), F.octet_length(text).cast("long").alias("length"),
                        F.sha2(text, 256).alias("digest"))
    rows = (rows.groupBy("page_id", "length", "digest").agg(F.count(F.lit(1)).alias("copies"))
            .withColumn("file", F.floor(F.col("page_id") / file_pages).cast("long"))
            .withColumn("begins", F.substring("digest", 1, 2)))
    bytes_ = F.sum(F.col("length") * F.col("copies"))
    cell = ["file", "page_id", "begins"]

    def earlier(group, *order):
        return Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)

    slices = rows.groupBy(*cell).agg(bytes_.alias("bytes"))
    slices = slices.select(*cell, F.coalesce(F.sum("bytes").over(earlier(["file"], "page_id", "begins")), F.lit(0)).alias("first"))
    inside = F.coalesce(bytes_.over(earlier(cell, "digest", "length")), F.lit(0))
    return (rows.withColumn("inside", inside).join(slices, cell)
            .withColumn("offset", (F.col("first") + F.col("inside")).cast("long"))
            .select("file", "offset", "length", "copies", "digest", "page_id"))


# Trees

class Tree:
    """Levels of nodes (file, node, digest), records first; `spans` are bytes, then files, of a node."""

    def __init__(self, records: DataFrame, spans: list[tuple[str, int]]):
        self.records, self.spans = records, spans
        leaf = F.concat_ws(":", "offset", "length", "copies", "digest")
        nodes = records.select("file", F.col("offset").alias("at"), leaf.alias("digest"))
        self.levels = []
        for kind, span in spans:
            key = _node(kind, span, F.col("file"), F.col("at"))
            nodes = checkpointed(
                nodes.select(*key, F.struct("file", "at", "digest").alias("child")).groupBy("file", "node")
                .agg(F.sha2(F.array_join(F.transform(F.sort_array(F.collect_list("child")), lambda c: F.concat_ws(
                    "@", c["file"], c["at"], c["digest"])), ","), 256).alias("digest")))
            self.levels.append(nodes)
            nodes = nodes.withColumnRenamed("node", "at")


def _node(kind: str, span: int, file: Column, at: Column) -> tuple[Column, Column]:
    """The node over a child: the first byte of its range, or the first of its files."""
    if kind == "bytes":
        return file.alias("file"), (F.floor(at / span) * span).cast("long").alias("node")
    if kind == "files":
        file = (F.floor(file / span) * span).cast("long")
    else:
        file = F.lit(0).cast("long")
    return file.alias("file"), F.lit(0).cast("long").alias("node")


def spans_of(*replicas: DataFrame, least: int = RANGE, fanout: int = FANOUT) -> list[tuple[str, int]]:
    """The levels that lead from the records of all replicas to one root."""
    last, files = 0, []
    for r in replicas:
        row = r.agg(F.max("offset"), F.min("file"), F.max("file")).first()
        last, files = max(last, row[0] or 0), [*files, *(x for x in row[1:] if x is not None)]
    spans = [("bytes", least)]
    while spans[-1][1] <= last:
        spans.append(("bytes", spans[-1][1] * fanout))
    span = 1
    while files and max(files) // span - min(files) // span >= fanout:
        span *= fanout
        spans.append(("files", span))
    return [*spans, ("root", 0)]


class Audit(NamedTuple):
    """`found` are the records that differ: (file, offset, page_id, problem, digest_one, digest_two);
    `moved` those that only lie elsewhere in their file: (file, page_id, digest, offset_one, offset_two);
    `counts` the differing nodes of each level looked at, from the root down."""
    found: DataFrame
    counts: list[int]
    moved: DataFrame


def audit(one: Tree, two: Tree) -> Audit:
    """What differs between two replicas.

    `problem` is altered (a record of the same id, or other numbers of copies), missing (only in the first
    replica) or added (only in the second). `offset` is that in the first replica that has the record.
    """
    assert one.spans == two.spans
    below, counts = None, []
    for level in range(len(one.spans) - 1, -1, -1):
        a, b = one.levels[level], two.levels[level]
        if below is not None:
            a, b = (_under(x, below, one.spans[level + 1], "node") for x in (a, b))
        both = a.withColumnRenamed("digest", "a").join(b.withColumnRenamed("digest", "b"), ["file", "node"], "full")
        below = checkpointed(both.filter(~F.col("a").eqNullSafe(F.col("b"))).select("file", "node"))
        counts.append(below.count())
        if not counts[-1]:
            break
    a, b = (_under(x.records, below, one.spans[0] if counts[-1] else one.spans[level], "offset") for x in (one, two))
    content = ["file", "page_id", "digest", "length"]

    def named(x, side):
        return x.select(*content, F.struct("offset", "copies", "digest").alias(side))

    both = checkpointed(named(a, "a").join(named(b, "b"), content, "full"))
    same = F.col("a").isNotNull() & F.col("b").isNotNull()
    moved = both.filter(same & (F.col("a.offset") != F.col("b.offset"))).select(
        "file", "page_id", "digest", F.col("a.offset").alias("offset_one"), F.col("b.offset").alias("offset_two"))
    copies = both.filter(same & (F.col("a.copies") != F.col("b.copies"))).select("file", "page_id", "a", "b")
    # Records of one id that no other one equals are told apart by their order.
    nth = F.row_number().over(Window.partitionBy("file", "page_id").orderBy("offset")).alias("nth")

    def alone(side, other):
        return both.filter(F.col(other).isNull()).select("file", "page_id", side, F.col(f"{side}.offset").alias("offset")).select(
            "file", "page_id", side, nth)

    pairs = alone("a", "b").join(alone("b", "a"), ["file", "page_id", "nth"], "full").select("file", "page_id", "a", "b")
    problem = (F.when(F.col("b").isNull(), "missing").when(F.col("a").isNull(), "added").otherwise("altered"))
    found = copies.unionByName(pairs).select(
        "file", F.coalesce("a.offset", "b.offset").alias("offset"), "page_id", problem.alias("problem"),
        F.col("a.digest").alias("digest_one"), F.col("b.digest").alias("digest_two"))
    return Audit(found, counts, moved)


def _under(nodes: DataFrame, parents: DataFrame, span: tuple[str, int], at: str) -> DataFrame:
    """The nodes below `parents`."""
    file, node = _node(*span, F.col("file"), F.col(at))
    named = parents.select(F.col("file").alias("__file"), F.col("node").alias("__node"))
    keyed = nodes.withColumn("__f", file).withColumn("__n", node)
    same = (F.col("__f") == F.col("__file")) & (F.col("__n") == F.col("__node"))
    return keyed.join(named, same, "left_semi").drop("__f", "__n")


def compare(one: DataFrame, two: DataFrame, least: int = RANGE, fanout: int = FANOUT) -> Audit:
    """`audit` of two archives (as `archive` gives them); empty ones are equal."""
    one, two = checkpointed(one), checkpointed(two)
    spans = spans_of(one, two, least=least, fanout=fanout)
    return audit(Tree(one, spans), Tree(two, spans))


# A replica with damage, for trials

def damaged(pages: DataFrame, id_col: str = "page_id", payload_col: str = "html",
            file_pages: int = FILE_PAGES) -> DataFrame:
    """Pages as a bad copy has them: where the MD5 of the id begins with 00, the first character is
    changed; each third file has lost a page inside it, and each seventh its last three."""
    first = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit(""))).substr(1, 2)
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    other = F.when(payload.startswith("#"), "!").otherwise("#")
    page_id = F.coalesce(F.col(id_col).cast("long"), F.lit(-1).cast("long"))
    file, place = F.floor(page_id / file_pages), F.pmod(page_id, F.lit(file_pages))
    lost = ((file % 7 == 3) & (place >= file_pages - 3)) | ((file % 3 == 0) & (place == file_pages // 5))
    changed = F.concat(other, F.substr(payload, F.lit(2)))
    return pages.filter(~lost).withColumn(payload_col, F.when(first == "00", changed).otherwise(payload))
