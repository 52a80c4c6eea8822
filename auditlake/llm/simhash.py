"""SimHash near-dedup: fingerprints, bit-sliced neighbour search, components.

Two fingerprints at most `RADIUS` bits apart agree in full on at least two of five bit blocks, so
that each pair meets in one of ten tables keyed by two blocks. A bucket holds its fingerprints as
vertical bit planes; a probe is compared with all of them at once by a carry-save counter that
saturates above the radius, and the probe is abandoned once every lane has saturated.

A bucket with more than `BUCKET` distinct fingerprints is dealt anew by a further block: the bits
not fixed yet are cut in four, and a pair at distance three or less agrees on one of these. After
three such levels at most 2**17 distinct fingerprints can share a bucket, so no group is unbounded.
"""

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, new_name

RADIUS = 3
SHINGLE = 3
SEED = 42
BUCKET = 4096
LEVELS = 3
_SIGN = 1 << 64


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint of one text, unsigned; 0 for a null text or one without words."""
    if not text:
        return 0
    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(sizes)
    joined = b" ".join(words)
    starts = (ends - sizes)[:n].tolist()
    stops = (ends[min(shingle, len(words)) - 1:] - 1).tolist()
    slices = map(joined.__getitem__, map(slice, starts, stops))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, slices, repeat(SEED)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 15):
        part = hashes[at:at + (1 << 15)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def _signed(value: int) -> int:
    return value - _SIGN if value >> 63 else value


def fingerprint_column(text: Column, shingle: int = SHINGLE) -> Column:
    """The fingerprint as a long (two's complement)."""
    @F.pandas_udf("long")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([_signed(fingerprint(t, shingle)) for t in batch], dtype="int64")
    return run(text.cast("string"))


def fingerprint_hex(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


# Masks of fixed bits

def _cut(bits: list[int], parts: int) -> list[int]:
    """`bits` cut in `parts` nearly equal runs, as masks."""
    return [sum(1 << b for b in run) for run in np.array_split(np.array(bits, dtype=object), parts)]


def _first_masks(radius: int) -> list[int]:
    blocks = _cut(list(range(64)), radius + 2)
    return [_signed(a | b) for a, b in combinations(blocks, 2)]


def _finer_masks(mask: int, radius: int) -> list[int]:
    free = [b for b in range(64) if not (mask >> b) & 1]
    return [_signed((mask & (_SIGN - 1)) | part) for part in _cut(free, radius + 1)]


# Bit-sliced comparison within a bucket

def near_lanes(planes: list[tuple[int, int]], value: int, full: int, radius: int) -> int:
    """Lanes at most `radius` bits from `value`: one counter bit plane per power of two."""
    # The counter starts so high that passing the radius carries out of it.
    width = radius.bit_length()
    start = (1 << width) - 1 - radius
    digits = [full if (start >> d) & 1 else 0 for d in range(width)]
    over = 0
    for bit, plane in planes:
        carry = plane ^ full if (value >> bit) & 1 else plane
        for d, digit in enumerate(digits):
            digits[d] = digit ^ carry
            carry &= digit
            if not carry:
                break
        else:
            over |= carry
            if over == full:
                return 0
    return full & ~over


def bucket_forest(values: list[int], mask: int, radius: int = RADIUS) -> list[tuple[int, int]]:
    """Edges (member, seed) that join what is linked inside the bucket, at most one per member."""
    n = len(values)
    values = [v & (_SIGN - 1) for v in values]
    if n <= 4:
        edges, left = [], list(range(n))
        while left:
            seed = left.pop()
            todo = [seed]
            while todo:
                v = values[todo.pop()]
                near = [i for i in left if (v ^ values[i]).bit_count() <= radius]
                left = [i for i in left if i not in near]
                todo += near
                edges += [(values[i], values[seed]) for i in near]
        return edges
    full = (1 << n) - 1
    wide = np.array(values, dtype=np.uint64)
    planes = []
    for bit in range(64):
        if not (mask >> bit) & 1:
            lanes = np.packbits((wide >> np.uint64(bit)) & np.uint64(1) != 0, bitorder="little")
            planes.append((bit, int.from_bytes(lanes.tobytes(), "little")))
    edges, left = [], full
    while left:
        seed = left.bit_length() - 1
        left ^= 1 << seed
        todo = [seed]
        while todo and left:
            near = near_lanes(planes, values[todo.pop()], full, radius) & left
            left ^= near
            while near:
                i = near.bit_length() - 1
                near ^= 1 << i
                todo.append(i)
                edges.append((values[i], values[seed]))
    return edges


def _forests(radius: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            edges = [e for mask, members in zip(batch["mask"], batch["members"])
                     for e in bucket_forest([int(m) for m in members], int(mask), radius)]
            yield pd.DataFrame({"a": [_signed(max(e)) for e in edges],
                                "b": [_signed(min(e)) for e in edges]}, dtype="int64")
    return run


def links(prints: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """Edges (a, b) of distinct fingerprints `fp`, enough to connect all that are linked."""
    if not 0 <= radius <= 7:
        raise ValueError("radius must be from 0 to 7")
    masks = _first_masks(radius)
    rows = prints.withColumn("mask", F.explode(F.array(*map(F.lit, masks))))
    found = None
    for level in range(LEVELS + 1):
        rows = rows.withColumn("key", F.col("fp").bitwiseAND(F.col("mask")))
        if level < LEVELS:
            counts = rows.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n"))
            hot = checkpointed(counts.filter(F.col("n") > bucket).select("mask", "key"))
            more = not hot.isEmpty()
        else:
            more = False
        cold = rows.join(hot, ["mask", "key"], "left_anti") if more else rows
        grouped = (cold.groupBy("mask", "key").agg(F.collect_list("fp").alias("members"))
                   .filter(F.size("members") > 1).select("mask", "members"))
        edges = grouped.mapInPandas(_forests(radius), "a long, b long")
        found = edges if found is None else found.unionByName(edges)
        if not more:
            break
        finer = {m: _finer_masks(m, radius) for m in masks}
        table = F.create_map(*[F.lit(x) if i == 0 else F.array(*map(F.lit, x))
                               for m, parts in finer.items() for i, x in enumerate((m, parts))])
        rows = (rows.join(hot, ["mask", "key"], "left_semi")
                .select("fp", F.explode(table[F.col("mask")]).alias("mask")))
        rows = checkpointed(rows)
        masks = list(dict.fromkeys(x for parts in finer.values() for x in parts))
    return found.distinct()


# Components

def _size_of(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")),
                           F.bit_xor(F.xxhash64("b", "a", F.lit(1)))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of `edges`: the smallest node it reaches, by alternating stars."""
    def large(e):
        both = e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()

    def small(e):
        least = e.groupBy("a").agg(F.min("b").alias("m"))
        moved = e.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        return moved.union(least.select("a", F.col("m").alias("b"))).distinct()

    now = checkpointed(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                       .filter("a <> b").distinct())
    size = _size_of(now)
    while size[0]:
        now = checkpointed(small(large(now)))
        before, size = size, _size_of(now)
        if size == before:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


def fingerprint_groups(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fp, component_id, keep_fp) for rows (doc_id, fp).

    `component_id` is the smallest non-null doc_id reachable, null if there is none; `keep_fp` is
    the fingerprint of that document (the smallest, if the id occurs with several).
    """
    unique = checkpointed(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(links(unique.select("fp"), radius))
    nodes = (unique.join(roots, unique["fp"] == roots["node"], "left")
             .select("fp", "least", F.coalesce("root", "fp").alias("root")))
    first = F.min(F.struct(F.col("least").isNull().alias("none"), "least", "fp"))
    chosen = nodes.groupBy("root").agg(first.alias("first"))
    return nodes.join(chosen, "root").select("fp", F.col("first.least").alias("component_id"),
                                             F.col("first.fp").alias("keep_fp"))


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   radius: int = RADIUS, shingle: int = SHINGLE) -> DataFrame:
    """One row (doc_id, fp, component_id) per row of `docs`; other columns are not looked at.

    Null and wordless texts have fingerprint zero and link like any other. Repeated rows stay. A
    null id never names a component. An empty table gives an empty result.
    """
    prints = checkpointed(docs.select(F.col(id_col).alias("doc_id"),
                                      fingerprint_column(F.col(text_col), shingle).alias("fp")))
    groups = fingerprint_groups(prints, radius).select("fp", "component_id")
    return prints.join(groups, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             radius: int = RADIUS, shingle: int = SHINGLE) -> DataFrame:
    """`docs` with one row of each group: that of the smallest id. Columns are those of `docs`."""
    # Names that `docs` does not have.
    fp, kept_fp, kept_id = (new_name(docs, n) for n in ("fp", "kept_fp", "kept_id"))
    texts = docs.withColumn(fp, fingerprint_column(F.col(text_col), shingle))
    prints = checkpointed(texts.select(F.col(id_col).alias("doc_id"), F.col(fp).alias("fp")))
    kept = (fingerprint_groups(prints, radius).filter("fp = keep_fp")
            .select(F.col("fp").alias(kept_fp), F.col("component_id").alias(kept_id)))
    texts = docs.join(kept.select(kept_id).distinct(), F.col(id_col).eqNullSafe(F.col(kept_id)), "left_semi")
    texts = texts.withColumn(fp, fingerprint_column(F.col(text_col), shingle))
    same = (F.col(fp) == F.col(kept_fp)) & F.col(id_col).eqNullSafe(F.col(kept_id))
    return texts.join(kept, same, "left_semi").dropDuplicates([fp]).select(*docs.columns)
