"""A seen-id sketch as a table of bitmaps.

The filter is split into blocks of one 32,768-bit bitmap each; a hash of the id
picks the block and all its bits lie in it. So a test is one join on the block,
not one per bit. No id that was added is ever missed.
"""

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dedup import ARRIVAL
from .skew import HOT_ROWS, hot_keys, salted_join

# Bits of the bitmap built by `bitmap_construct_agg`.
BLOCK_BITS = 4096 * 8
BLOCK_BYTES = BLOCK_BITS // 8
MAX_BROADCAST_BYTES = 256 * 1024 * 1024


class BloomSize(NamedTuple):
    blocks: int
    hashes: int


def bloom_size(items: int, fpp: float) -> BloomSize:
    """Blocks and bits per id for `items` ids at false-positive rate `fpp`."""
    bits = math.ceil(-items * math.log(fpp) / math.log(2) ** 2)
    return BloomSize(math.ceil(bits / BLOCK_BITS), math.ceil(bits / items * math.log(2)))


def _block(event_id: Column, size: BloomSize) -> Column:
    return F.pmod(F.xxhash64(event_id), F.lit(size.blocks))


def _bits(event_id: Column, size: BloomSize) -> Column:
    """Two more hashes give all positions (double hashing)."""
    start = F.xxhash64(event_id, F.lit(1))
    step = F.xxhash64(event_id, F.lit(2)).bitwiseOR(F.lit(1))
    return F.array(*[
        F.pmod(F.pmod(start, F.lit(BLOCK_BITS)) + F.pmod(step, F.lit(BLOCK_BITS)) * i, F.lit(BLOCK_BITS))
        for i in range(size.hashes)])


def bloom_build(ids: DataFrame, items: int, fpp: float, id_col: str = "event_id") -> DataFrame:
    """`(block, bitmap)` of all ids.

    Repeats go first (combined before their shuffle), then each block's ids meet in
    one task: bitmaps of many blocks per input task would cost far more to move.
    """
    size, c = bloom_size(items, fpp), F.col(id_col)
    return (ids.select(c).distinct()
            .select(_block(c, size).alias("block"), _bits(c, size).alias("bits"))
            .repartition("block")
            .select("block", F.explode("bits").alias("bit"))
            .groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bitmap")))


def bloom_merge(a: DataFrame, b: DataFrame) -> DataFrame:
    """The sketch of both id sets; both must have been built for the same size."""
    return a.select("block", "bitmap").unionByName(b.select("block", "bitmap")).groupBy("block").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def bitmap_words(bitmap: Column, words: Column | None = None) -> Column:
    """The first `words` 64-bit words of a bitmap (all by default), made once for it and not for each test."""
    def word(i):
        return F.conv(F.hex(F.substring(bitmap, i * 8 + 1, F.lit(8))), 16, -10).cast("bigint")

    last = F.lit(BLOCK_BYTES // 8 - 1) if words is None else (words - 1).cast("int")
    return F.transform(F.sequence(F.lit(0), last), word)


def has_bit(words: Column, bit: Column) -> Column:
    """Whether a bit is set; null beyond the last word."""
    # Byte k of a bitmap holds bits 8k to 8k+7, and a word begins with its first byte.
    place = 56 - 8 * F.floor(F.pmod(bit, F.lit(64)) / 8) + F.pmod(bit, F.lit(8))
    return F.getbit(F.get(words, F.floor(bit / 64).cast("int")), place.cast("int")) == 1


def _probe_ids(ids: DataFrame, bloom: DataFrame, size: BloomSize, broadcast: bool) -> DataFrame:
    c = F.col("event_id")
    bits = _bits(c, size)
    hit = F.lit(True)
    for i in range(size.hashes):
        hit = hit & has_bit(F.col("_words"), F.get(bits, F.lit(i)))
    blocks = bloom.select(F.col("block").alias("_block"), bitmap_words(F.col("bitmap")).alias("_words"))
    blocks = F.broadcast(blocks) if broadcast else blocks
    return (ids.join(blocks, _block(c, size) == F.col("_block"), "left")
            .withColumn("maybe_seen", F.coalesce(hit, F.lit(False))).drop("_block", "_words"))


def bloom_probe(records: DataFrame, bloom: DataFrame, items: int, fpp: float, unique: bool = False,
                size: BloomSize | None = None, spread=ARRIVAL, max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
                min_rows: int = HOT_ROWS) -> DataFrame:
    """Add `maybe_seen`: false only for ids that were surely never added.

    `size` is that of a stored sketch, where it may differ from the one of `items` and `fpp`.

    The sketch has a fixed size, so whether it may be broadcast follows from its
    parameters. A larger one is joined on the block with one row per id (ids
    spread evenly over blocks), and the answer is joined back with hot ids salted.
    """
    size = size or bloom_size(items, fpp)
    if size.blocks * BLOCK_BYTES <= max_broadcast_bytes:
        return _probe_ids(records, bloom, size, broadcast=True)
    if unique:
        return _probe_ids(records, bloom, size, broadcast=False)
    counts = records.groupBy("event_id").agg(F.count(F.lit(1)).alias("copies"))
    answers = _probe_ids(counts, bloom, size, broadcast=False).select("event_id", "maybe_seen")
    return salted_join(records, answers, ["event_id"], "inner",
                       hot_keys(counts, ["event_id"], min_rows=min_rows), list(spread))
