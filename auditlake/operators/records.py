"""Good records, unusable records, unusable files."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.events import parse_event_time, project_minimal, resolve_account

REJECT_REASONS = ["malformed", "bad_time", "no_account"]


def classify_records(records: DataFrame, strict: bool = True) -> DataFrame:
    """Parse `raw` and add `reject_reason`, null for a record that can be stored."""
    parsed = resolve_account(parse_event_time(project_minimal(records, strict)))
    reason = (F.when(F.col("malformed"), "malformed")
              .when(~F.col("time_ok"), "bad_time")
              .when(F.col("account_id").isNull(), "no_account"))
    return (parsed.withColumn("reject_reason", reason)
            .drop("malformed", "time_ok", "identity_account_id", "recipient_account_id"))


def reject_files(listed: DataFrame, files: DataFrame) -> DataFrame:
    """The listed files that could not be read as one log file.

    `listed` has `key`; `files` has `key` and `_corrupt`, one row or many per file
    that gave anything. Row counts per file are combined before the shuffle.
    """
    read = files.groupBy("key").agg(F.bool_or(F.col("_corrupt").isNotNull()).alias("_bad"))
    return listed.join(read.filter(~F.col("_bad")).select("key"), "key", "left_anti")
