"""Which ids were written before: asked of layered sketches, then of the ids themselves.

Ids lie in order of their hash, in folders that each hold a range of hashes and in pages of few rows.
Their columns' statistics then tell Parquet's reader which pages can hold a hash, so that a few hits read
a few pages of each folder of ids, however long the history. More hits read whole folders, only those
whose ranges they fall into; the hits go to the ids by broadcast while they are few enough, so that the
ids are not moved.

Each run writes a sketch of its own new ids only, a layer, and each merged folder of ids has one of its
own size. Layers of one size are joined bit by bit as long as they hold no more ids together than one of
them is made for; what is left is asked one after another.
"""

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.bloom import BLOCK_BYTES, MAX_BROADCAST_BYTES, BloomSize, bloom_build, bloom_probe, bloom_size
from ..schemas import BLOOM
from ..session import file_system
from .tables import IdFolders, read_seen, seen_segments, segment_id, table_path

#: Ranges of hashes that folders are chosen by; a power of two.
CELLS = 4096
#: Hashes asked for in one scan of pages, and scans at most.
PUSHED, SCANS = 128, 16
#: Ids in a page of the id table: what a single hit has to read.
PAGE_IDS = 200
#: Hits that are broadcast, as rows of an id and its hash.
MAX_BROADCAST_HITS = 1_000_000


# Ids in order of their hash

def id_hash(event_id) -> Column:
    return F.xxhash64(event_id)


def _high(hashed: Column) -> Column:
    """The upper 31 bits, counted from 0."""
    return F.shiftright(hashed, 33) + 2 ** 30


def id_slot(hashed: Column, slots) -> Column:
    """The folder of a hash: the range of hashes cut in `slots` equal parts."""
    return F.shiftright(_high(hashed) * slots, 31).cast("int")


def _cell(hashed: Column) -> Column:
    return F.shiftright(_high(hashed), 19)


def _in_folders(cells: list[int]) -> Column:
    """A filter on folders alone, whatever number of them each was dealt to; the rest is not listed."""
    slots, slot = F.col("id_slots").cast("long"), F.col("id_slot")

    def meets(cell: Column) -> Column:
        return ((F.shiftright(cell * slots, 12) <= slot)
                & (slot <= F.shiftright((F.shiftleft(cell + 1, 19) - 1) * slots, 31)))

    return F.exists(F.array(*[F.lit(c).cast("long") for c in cells]), meets)


def _any(tests: list[Column]) -> Column:
    """One of many, as a tree of even depth."""
    while len(tests) > 1:
        tests = [reduce(lambda a, b: a | b, tests[i:i + 2]) for i in range(0, len(tests), 2)]
    return tests[0]


def narrowed(seen: DataFrame, hits: DataFrame, most: int = PUSHED * SCANS) -> DataFrame:
    """The rows of the id table that can be among `hits` (with `id_hash`), by folders, and by pages while
    there are at most `most` hashes."""
    few = [r.id_hash for r in hits.select("id_hash").distinct().limit(most + 1).collect()]
    if len(few) > most:
        cells = [r[0] for r in hits.select(_cell(F.col("id_hash"))).distinct().collect()]
        return seen if len(cells) == CELLS else seen.filter(_in_folders(cells))
    return _pages_of(seen, sorted(few))


def _pages_of(seen: DataFrame, few: list[int]) -> DataFrame:
    if not few:
        return seen.filter(F.lit(False))
    parts = []
    for at in range(0, len(few), PUSHED):
        some, hashed = few[at:at + PUSHED], F.col("id_hash")
        cells = sorted({((h >> 33) + 2 ** 30) >> 19 for h in some})
        parts.append(seen.filter(_in_folders(cells) & hashed.between(some[0], some[-1])
                                 & _any([hashed == F.lit(h) for h in some])))
    return reduce(DataFrame.unionByName, parts)


def known_among(spark: SparkSession, root: str, runs: list[str], hits: DataFrame, keys: list[str],
                max_broadcast: int = MAX_BROADCAST_HITS, ids: int | None = None,
                folders: IdFolders | None = None) -> DataFrame:
    """The `keys` of those `hits` (event_id, event_date) that a run has written.

    `ids` is how many the runs wrote, where that is known: if the hits would ask for as many pages as there
    are, all are read, by one plain scan. `folders` are the runs' `seen_segments`, if they are known.
    """
    folders = folders or seen_segments(spark, root, runs)
    hits = hits.withColumn("id_hash", id_hash("event_id"))
    seen, most, on = read_seen(spark, root, runs, folders), PUSHED * SCANS, ["id_hash", *keys]
    asked = hits.select(*on)
    few = [r.id_hash for r in asked.limit(most + 1).collect()]
    # A hit asks for a page of each run, or of those it was merged with.
    if ids is None or ids > PAGE_IDS * len(few) * sum(map(len, folders)):
        seen = _pages_of(seen, sorted(set(few))) if len(few) <= most else narrowed(seen, hits, most)
    if len(few) <= most or asked.limit(max_broadcast + 1).count() <= max_broadcast:
        asked = F.broadcast(asked)
    return seen.select(*on).join(asked, on, "left_semi").select(*keys).distinct()


# Layers

class Layer(NamedTuple):
    """A sketch of one size: `items` is what it was made for, `added` what it holds."""
    table: DataFrame
    size: BloomSize
    items: int
    added: int

    @property
    def bytes(self) -> int:
        return self.size.blocks * BLOCK_BYTES


def layer_of(ids: DataFrame, count: int, items: int, fpp: float) -> DataFrame:
    """The sketch of `count` ids, as it is stored; made for `items`, or four times as many and so on."""
    while items < count:
        items *= 4
    size = bloom_size(items, fpp)
    return bloom_build(ids, items, fpp).withColumns({
        "blocks": F.lit(size.blocks).cast("bigint"), "hashes": F.lit(size.hashes),
        "items": F.lit(items).cast("bigint"), "added": F.lit(count).cast("bigint")})


def known_layers(spark: SparkSession, root: str, runs: list[str], items: int, fpp: float,
                 folders: IdFolders | None = None) -> list[Layer]:
    """The sketches of all ids of `runs`, as few as their sizes let them be.

    Runs that kept none (as without a sketch) get one here, from their ids.
    """
    segments, behind = folders or seen_segments(spark, root, runs)
    names = [("bloom_base", segment_id(a, b)) for a, b, _ in segments] + [("bloom", r) for r in behind]
    there, missing = [], []
    for table, name in names:
        path = table_path(root, table, name)
        fs, at = file_system(spark, path)
        (there if fs.exists(at) else missing).append((table, name, path))

    stacks: list[dict] = []
    if there:
        kinds = ["blocks", "hashes", "items", "added"]
        parts = [spark.read.schema(BLOOM).option("basePath", table_path(root, table)).parquet(
            *[p for t, _, p in there if t == table]) for table in sorted({t for t, *_ in there})]
        # One row for each layer.
        found = {r.run_id: r for r in reduce(DataFrame.unionByName, parts).select("run_id", *kinds).distinct().collect()}
        for _, name, path in there:
            if name not in found:
                continue
            r = found[name]
            for stack in stacks:
                if stack["kind"] == (r.blocks, r.hashes) and stack["added"] + r.added <= stack["items"]:
                    stack["paths"].append(path)
                    stack["added"] += r.added
                    break
            else:
                stacks.append({"kind": (r.blocks, r.hashes), "items": r["items"], "added": r.added, "paths": [path]})
    layers = []
    for stack in stacks:
        rows = spark.read.schema(BLOOM).parquet(*stack["paths"]).select("block", "bitmap")
        if len(stack["paths"]) > 1:
            rows = rows.groupBy("block").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
        layers.append(Layer(rows, BloomSize(*stack["kind"]), stack["items"], stack["added"]))
    if missing:
        lost = [name for _, name, _ in missing]
        ids = read_seen(spark, root, runs, (segments, behind)).filter(F.col("run_id").isin(lost))
        count = ids.count()
        if count:
            while items < count:
                items *= 4
            layers.append(Layer(bloom_build(ids, items, fpp), bloom_size(items, fpp), items, count))
    return layers


def probe_layers(groups: DataFrame, layers: list[Layer], fpp: float,
                 max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Add `maybe_seen` to rows of unique `event_id`: false for ids that no layer holds.

    Layers are broadcast while they are small enough together, the smallest first; larger ones are
    joined by their block.
    """
    out = groups.withColumn("_maybe", F.lit(False))
    left = max_broadcast_bytes
    for layer in sorted(layers, key=lambda x: x.bytes):
        out = bloom_probe(out, layer.table, layer.items, fpp, unique=True, size=layer.size,
                          max_broadcast_bytes=left if layer.bytes <= left else 0)
        left -= min(left, layer.bytes)
        out = out.withColumn("_maybe", F.col("_maybe") | F.col("maybe_seen")).drop("maybe_seen")
    return out.withColumnRenamed("_maybe", "maybe_seen")
