"""The records of log files that lose a dedup, as a bitmap of ordinals for each file.

Whether a record is written is decided on narrow rows. What is left to carry to the text is one bit for
each record, kept with the row of the file, so that losers go before the records are exploded and the
text is neither joined nor moved.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .bloom import BLOCK_BITS, bitmap_words, has_bit

#: Bytes of bitmaps that are broadcast with the files of one scan.
MAX_BYTES = 64 * 1024 * 1024


def loser_bitmaps(losers: DataFrame, keys: Sequence[str] = ("file_no",)) -> DataFrame:
    """(file_no, losers, bytes) for rows (file_no, ordinal); other `keys` may stand for the file.

    `losers` has an array of 64-bit words for each 32,768 ordinals, no longer than the last loser asks
    for. Rows meet by file and part of it: a bitmap in each input task would be far more to move.
    """
    parts = (losers.select(*keys, F.floor(F.col("ordinal") / BLOCK_BITS).cast("int").alias("part"),
                           F.pmod("ordinal", F.lit(BLOCK_BITS)).alias("bit"))
             .repartition(*keys, "part").groupBy(*keys, "part")
             .agg(F.bitmap_construct_agg("bit").alias("bitmap"), F.max("bit").alias("last")))
    words = bitmap_words(F.col("bitmap"), F.floor(F.col("last") / 64) + 1)
    none = F.array().cast("array<bigint>")
    found = (parts.groupBy(*keys)
             .agg(F.map_from_entries(F.collect_list(F.struct("part", words))).alias("parts"), F.max("part").alias("last")))
    filled = F.transform(F.sequence(F.lit(0), F.col("last")), lambda p: F.coalesce(F.try_element_at("parts", p), none))
    size = F.aggregate("losers", F.lit(0).cast("long"), lambda n, w: n + 8 * F.size(w))
    return found.select(*keys, filled.alias("losers")).withColumn("bytes", size)


def without_losers(records: Column, losers: Column) -> Column:
    """The array of a file's records without those whose bit is set; all of them where `losers` is null."""
    def stays(_, ordinal: Column) -> Column:
        words = F.get(losers, F.floor(ordinal / BLOCK_BITS).cast("int"))
        return ~F.coalesce(has_bit(words, F.pmod(ordinal, F.lit(BLOCK_BITS))), F.lit(False))

    return F.when(losers.isNull(), records).otherwise(F.filter(records, stays))


def scan_ranges(files: DataFrame, bitmaps: DataFrame, max_bytes: int = MAX_BYTES) -> list[tuple[int, int]]:
    """The files of a run (at most `max_files` rows) as ranges of `file_no` whose bitmaps may be broadcast
    together. One range in all but the largest runs; one row for each range comes to the driver."""
    sizes = files.select("file_no").join(bitmaps.select("file_no", "bytes"), "file_no", "left")
    first, last, total = sizes.agg(F.min("file_no"), F.max("file_no"), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    if total < max_bytes:
        return [] if first is None else [(first, last)]
    before = F.sum(F.coalesce("bytes", F.lit(0))).over(Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1))
    numbered = sizes.withColumn("range", F.floor(F.coalesce(before, F.lit(0)) / max_bytes))
    rows = numbered.groupBy("range").agg(F.min("file_no").alias("first"), F.max("file_no").alias("last")).collect()
    return sorted((r.first, r.last) for r in rows)
