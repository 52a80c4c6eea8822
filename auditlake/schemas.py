"""Table and record schemas."""

from pyspark.sql import types as T

LOG_SUFFIX = ".json.gz"
MISSING = ""

TRAIL = T.StructType([
    T.StructField("trail", T.StringType()),
    T.StructField("bucket", T.StringType()),
    T.StructField("prefix", T.StringType()),
    T.StructField("trail_rank", T.IntegerType()),
])

# One listed object. `key` is relative to the bucket, `path` is what a reader opens.
OBJECT = T.StructType([
    T.StructField("trail", T.StringType()),
    T.StructField("trail_rank", T.IntegerType()),
    T.StructField("bucket", T.StringType()),
    T.StructField("prefix", T.StringType()),
    T.StructField("key", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("size", T.LongType()),
    T.StructField("last_modified", T.TimestampType()),
])

# A log file read as one JSON value; every array element keeps its own text.
LOG_FILE = "Records array<string>, _corrupt string"

MINIMAL_EVENT = (
    "eventTime string, eventID string, awsRegion string, "
    "userIdentity struct<accountId string>, recipientAccountId string, _bad string"
)
# The same fields with their JSON type kept, to tell "7" from 7.
TYPED_EVENT = (
    "eventTime variant, eventID variant, awsRegion variant, "
    "userIdentity struct<accountId variant>, recipientAccountId variant"
)

PAIR = ["bucket", "prefix", "account_id", "region"]

CHECKPOINT = T.StructType([
    T.StructField("bucket", T.StringType()),
    T.StructField("prefix", T.StringType()),
    T.StructField("account_id", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("last_processed_key", T.StringType()),
    T.StructField("files_processed", T.LongType()),
    T.StructField("commits", T.LongType()),
    T.StructField("last_updated", T.TimestampType()),
])

FAILED_FILE = T.StructType([
    *[f for f in OBJECT.fields],
    T.StructField("org_id", T.StringType()),
    T.StructField("account_id", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("attempts", T.LongType()),
    T.StructField("retry_at", T.TimestampType()),
])

SEEN = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("event_date", T.StringType()),
    # Rows are sorted by the hash; its range is cut in `id_slots` folders, as many as the writer asked for.
    T.StructField("id_hash", T.LongType()),
    T.StructField("id_slots", T.IntegerType()),
    T.StructField("id_slot", T.IntegerType()),
    T.StructField("run_id", T.StringType()),
])

# The sketch of one run's new ids, or of a merged folder of ids.
BLOOM = T.StructType([
    T.StructField("block", T.LongType()),
    T.StructField("bitmap", T.BinaryType()),
    # The same in each row: what the sketch was made for, and the ids added to it.
    T.StructField("blocks", T.LongType()),
    T.StructField("hashes", T.IntegerType()),
    T.StructField("items", T.LongType()),
    T.StructField("added", T.LongType()),
    T.StructField("run_id", T.StringType()),
])

ROUTE = ["account_id", "region", "year", "month", "day", "hour"]

# What the text sink wrote. All partition values are text, so that
# "000000000001" and "00" come back as they were.
STORED_EVENT = T.StructType(
    [T.StructField(c, T.StringType()) for c in ["value", "run_id", *ROUTE]]
)

# A file of event lines that a run, or a merge of hours, wrote below its `run_id=` folder.
MANIFEST = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("folder", T.StringType()),
    *[T.StructField(c, T.StringType()) for c in ROUTE],
    T.StructField("file", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("bytes", T.LongType()),
])

# An hour folder of a run whose events a merge has written anew.
REPLACED = T.StructType([
    T.StructField("old_run", T.StringType()),
    T.StructField("folder", T.StringType()),
    T.StructField("run_id", T.StringType()),
])

COUNTERS = [
    "files_listed", "files_downloaded", "files_processed", "bytes_downloaded",
    "events_processed", "events_written", "events_duplicate",
    "events_malformed", "events_bad_time", "events_no_account",
    "hour_buffers", "jsonl_files", "errors",
]

METRICS = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("seq", T.LongType()),
    T.StructField("elapsed_seconds", T.DoubleType()),
    *[T.StructField(c, T.LongType()) for c in COUNTERS],
    T.StructField("finished_at", T.TimestampType()),
])
