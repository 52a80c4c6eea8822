"""Running numbers inside groups of any size."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.naming import file_name
from ..schemas import ROUTE
from .dedup import ARRIVAL


def running_number(df: DataFrame, group: Sequence[str], slices: Sequence[str], order: Sequence[str]) -> DataFrame:
    """`row_number() over (partition by group order by slices, order)` as `_number`.

    Rows are numbered inside each (group, slice); the rows of earlier slices, a
    small table, are added. So a task holds one slice, not one group.
    """
    cell = [*group, *slices]
    counts = df.groupBy(*cell).agg(F.count(F.lit(1)).alias("_rows"))
    earlier = W.partitionBy(*group).orderBy(*slices).rowsBetween(W.unboundedPreceding, -1)
    before = counts.select(*cell, F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    inside = df.withColumn("_inside", F.row_number().over(W.partitionBy(*cell).orderBy(*order)))
    return (inside.join(before, cell)
            .withColumn("_number", F.col("_before") + F.col("_inside")).drop("_before", "_inside"))


def assign_file_no(events: DataFrame, events_per_file: int = 10_000, route: Sequence[str] = ROUTE,
                   place: Sequence[str] = ARRIVAL) -> DataFrame:
    """Give each event the number of its file in its hour folder, and the file's name.

    Inside the hour, events are in order of time in whole seconds, then of id. A slice is a
    second and the first two characters of the id, so that no busy second is one task.
    """
    sliced = events.withColumns({
        "_second": F.floor(F.col("event_micros") / 1_000_000),
        "_spread": F.substring("event_id", 1, 2),
    })
    numbered = running_number(sliced, route, ["_second", "_spread"], ["event_id", *place])
    file_no = F.floor((F.col("_number") - 1) / events_per_file)
    return (numbered.withColumn("file_no", file_no).withColumn("file_name", file_name("file_no"))
            .drop("_second", "_spread", "_number"))
