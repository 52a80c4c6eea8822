"""Joins that hold when one key has a large part of all rows."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key with more rows is dealt to tasks of about this many. There are at most rows / HOT_ROWS
# such keys, which are broadcast: 16 MB for 10**12 rows.
HOT_ROWS = 1_000_000
# Object keys are at most 1 KiB, so a lookup table of this many rows is below 100 MB.
MAX_LOOKUP_ROWS = 50_000


def hot_keys(counts: DataFrame, keys: list[str], rows: str = "copies", min_rows: int = HOT_ROWS) -> DataFrame:
    """Hashes of the keys with at least `min_rows` rows and their number of salts, from one row per key."""
    return (counts.filter(F.col(rows) >= min_rows)
            .groupBy(F.xxhash64(*keys).alias("_hot"))
            .agg((F.floor(F.max(rows) / min_rows) + 1).cast("int").alias("_salts")))


def salted_join(left: DataFrame, right: DataFrame, keys: list[str], how: str, hot: DataFrame,
                spread: list[str]) -> DataFrame:
    """`left.join(right, keys, how)`, with hot keys of `left` over many tasks.

    `right` has each key once or seldom. `spread` are left columns that tell rows of
    one key apart; the salt is a hash of them, so a repeated task gives it again.
    """
    hot = F.broadcast(hot)
    key_hash = F.xxhash64(*keys)
    salted = (left.withColumn("_key", key_hash).join(hot, F.col("_key") == F.col("_hot"), "left")
              .withColumn("_salt", F.when(F.col("_hot").isNotNull(),
                                          F.pmod(F.xxhash64(*spread), F.col("_salts")).cast("int"))
                          .otherwise(0))
              .drop("_key", "_hot", "_salts"))
    every = F.when(F.col("_hot").isNotNull(), F.sequence(F.lit(0), F.col("_salts") - 1)).otherwise(F.array(F.lit(0)))
    copied = (right.withColumn("_key", key_hash).join(hot, F.col("_key") == F.col("_hot"), "left")
              .withColumn("_salt", F.explode(every)).drop("_key", "_hot", "_salts"))
    return salted.join(copied, [*keys, "_salt"], how).drop("_salt")


def lookup_join(left: DataFrame, lookup: DataFrame, keys: list[str], spread: list[str],
                how: str = "left", max_rows: int = MAX_LOOKUP_ROWS, min_rows: int = HOT_ROWS) -> DataFrame:
    """Join a table of one row per key: broadcast if its counted rows are few.

    A larger table is shuffled, with the hot keys of `left` salted.
    """
    if lookup.limit(max_rows + 1).count() <= max_rows:
        return left.join(F.broadcast(lookup), keys, how)
    counts = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    return salted_join(left, lookup, keys, how, hot_keys(counts, keys, min_rows=min_rows), spread)
