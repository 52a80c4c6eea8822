"""Labels, output names and rates."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import ROUTE


def route_key(cols=tuple(ROUTE)) -> Column:
    return F.concat_ws("/", *cols)


def state_key(bucket="bucket", account="account_id", region="region") -> Column:
    return F.concat_ws(":", bucket, account, region)


def file_name(file_no) -> Column:
    return F.format_string("events_%05d.jsonl", file_no)


def add_rates(metrics: DataFrame, elapsed: str = "elapsed_seconds") -> DataFrame:
    """Files, events and MiB per second; null unless time has passed."""
    def rate(c: str) -> Column:
        return F.when(F.col(elapsed) > 0, F.col(c) / F.col(elapsed))

    return metrics.withColumns({
        "download_rate": rate("files_downloaded"),
        "event_rate": rate("events_processed"),
        "mib_per_second": rate("bytes_downloaded") / 1024 / 1024,
    })
