"""One event per id."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .skew import HOT_ROWS, hot_keys, salted_join

# Who comes first: trail order, then object key, then place in the file.
ARRIVAL = ("trail_rank", "key", "ordinal")


def union_trails(*records: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, records)


def dedup_first(records: DataFrame, order: Sequence[str] = ARRIVAL, keep_missing_ids: bool = False) -> DataFrame:
    """The first record of each `event_id`, with `copies`, the rows it stands for.

    A minimum over a struct is combined before the shuffle, so that an id with a
    third of all rows reaches the final task as one row per input task.
    """
    rest = [c for c in records.columns if c not in order and c != "event_id"]
    keys = ["event_id"]
    if keep_missing_ids:
        # Each record without an id is a group of its own.
        records = records.withColumn("_place", F.when(F.col("event_id") == "", F.struct(*order)))
        keys.append("_place")
    first = F.min(F.struct(*order, *rest)).alias("_first")
    return (records.groupBy(*keys).agg(first, F.count(F.lit(1)).alias("copies"))
            .select("event_id", "_first.*", "copies")
            .select(*[c for c in records.columns if c != "_place"], "copies"))


def mark_duplicates(records: DataFrame, order: Sequence[str] = ARRIVAL, min_rows: int = HOT_ROWS) -> DataFrame:
    """All records, with `is_duplicate` true for all but the first of each id.

    No window: the first place of each id is an aggregate of narrow columns, joined
    back with hot ids salted.
    """
    place = F.struct(*order)
    firsts = records.groupBy("event_id").agg(F.min(place).alias("_first"), F.count(F.lit(1)).alias("copies"))
    # Asks for all columns of `firsts`, so that both uses share one shuffle.
    hot = hot_keys(firsts.filter(F.col("_first").isNotNull()), ["event_id"], min_rows=min_rows)
    marked = salted_join(records, firsts, ["event_id"], "inner", hot, list(order))
    later = place != F.col("_first")
    return marked.withColumn("is_duplicate", later & (F.col("copies") > 1)).drop("_first", "copies")


def same_dates(records: DataFrame, most: int = 1000) -> Column:
    """A filter that skips folders of `event_date`s the records do not have."""
    dates = [r.event_date for r in records.select("event_date").distinct().limit(most + 1).collect()]
    if len(dates) <= most:
        return F.col("event_date").isin(dates)
    low, high = records.agg(F.min("event_date"), F.max("event_date")).first()
    return F.col("event_date").between(low, high)


def drop_seen(records: DataFrame, seen: DataFrame, spread: Sequence[str] = ARRIVAL, unique: bool = False,
              prune_by_date: bool = False, min_rows: int = HOT_ROWS) -> DataFrame:
    """Records whose id is not in `seen`.

    `unique` says that ids do not repeat in `records` (it is the output of
    `dedup_first`): then no id can be hot. With `prune_by_date` only ids of the same
    event date are compared, so that `seen`, partitioned by it, is read in part.
    """
    keys = ["event_id"]
    if prune_by_date:
        keys.append("event_date")
        seen = seen.filter(same_dates(records))
    seen = seen.select(*keys)
    if unique:
        return records.join(seen, keys, "left_anti")
    counts = records.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    hot = hot_keys(counts, keys, min_rows=min_rows)
    return salted_join(records, seen, keys, "left_anti", hot, list(spread))
