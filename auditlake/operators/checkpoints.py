"""Last read key per bucket, prefix, account and region."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import PAIR
from ..session import scratch
from .numbering import running_number
from .skew import MAX_LOOKUP_ROWS, lookup_join


def pending_objects(objects: DataFrame, checkpoints: DataFrame, max_lookup_rows: int = MAX_LOOKUP_ROWS) -> DataFrame:
    """Objects whose key sorts, byte by byte, after the last read one of their pair."""
    last = checkpoints.select(*PAIR, "last_processed_key")
    joined = lookup_join(objects, last, PAIR, spread=["key"], max_rows=max_lookup_rows)
    return joined.filter(F.col("key") > F.coalesce("last_processed_key", F.lit(""))).drop("last_processed_key")


def advance_checkpoints(objects: DataFrame, every: int = 100, now=None) -> DataFrame:
    """The checkpoint rows that reading `objects` gives.

    `commits` counts the marks of `checkpoint_marks` plus the final one, which is
    made even when the last file already was a mark.
    """
    return (objects.groupBy(*PAIR)
            .agg(F.max("key").alias("last_processed_key"), F.count(F.lit(1)).alias("files_processed"))
            .withColumn("commits", F.expr(f"files_processed div {every} + 1"))
            .withColumn("last_updated", F.current_timestamp() if now is None else now))


def merge_checkpoints(old: DataFrame, new: DataFrame) -> DataFrame:
    """Upsert by pair: the later key, the added counts, the newest time."""
    return (old.unionByName(new).groupBy(*PAIR)
            .agg(F.max("last_processed_key").alias("last_processed_key"),
                 F.sum("files_processed").alias("files_processed"),
                 F.sum("commits").alias("commits"),
                 F.max("last_updated").alias("last_updated")))


def checkpoint_marks(objects: DataFrame, every: int = 100) -> DataFrame:
    """Every `every`-th object of each pair in key order, and the last one.

    Keys below a region folder are opaque, so slices of a pair can only come from
    sorting: the range partition a row fell into is written down once, in the
    shared folder, and then numbers the slices.
    """
    spark = objects.sparkSession
    path = scratch(spark, "marks")
    (objects.select(*PAIR, "key").repartitionByRange(*PAIR, "key")
     .withColumn("_slot", F.spark_partition_id()).write.parquet(path))
    placed = spark.read.parquet(path)
    numbered = running_number(placed, PAIR, ["_slot"], ["key"])
    last = placed.groupBy(*PAIR).agg(F.max("key").alias("_last"))
    marked = lookup_join(numbered, last, PAIR, spread=["key"])
    return (marked.withColumn("is_last", F.col("key") == F.col("_last"))
            .filter((F.col("_number") % every == 0) | F.col("is_last"))
            .select(*PAIR, "key", F.col("_number").alias("file_no"), "is_last"))
