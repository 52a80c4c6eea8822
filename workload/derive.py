"""Audit records, object listings and log files, derived by Spark from `events`."""

import gzip
import posixpath

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auditlake import IngestOptions, Trail
from auditlake.session import scratch

BUCKET = "audit-bucket"
ORG = "o-abc123"
# Rank 0 and 1: on a tie the organization's copy is kept.
TRAILS = [Trail("org-trail", BUCKET, "logs"), Trail("local-trail", BUCKET, "")]
# Events of one log file come from one block of this many event numbers.
BLOCK = 5000
# The earlier run's data ends here.
SPLIT_DAY = "16"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", "user_id", "event_type")


# All events of a dense set are of this day: few hour folders, with many events each.
DENSE_DAY = "2024-01-01"


def _base(spark: SparkSession, sf_dir: str, dense: bool = False) -> DataFrame:
    ts = F.col("ts").cast("string")
    day = F.lit(DENSE_DAY) if dense else F.substring(ts, 1, 10)
    return events(spark, sf_dir).select(
        F.col("event_id").alias("i"),
        F.lpad((F.pmod("user_id", F.lit(7)) + 1).cast("string"), 12, "0").alias("acct"),
        F.when(F.col("event_type") == "click", "us-east-1").when(F.col("event_type") == "view", "eu-west-1")
        .otherwise("ap-south-1").alias("rg"),
        F.concat(day, F.lit("T"), F.substring(ts, 12, 8), F.lit("Z")).alias("iso"),
        F.md5(F.col("event_id").cast("string")).alias("eid"))


def _every(n: int, rest: int):
    return F.pmod("i", F.lit(n)) == rest


def _raw():
    no_account = _every(60, 2)
    recipient = F.when(no_account | _every(40, 1), "").otherwise(
        F.concat(F.lit(',"recipientAccountId":"'), "acct", F.lit('"')))
    whole = F.concat(
        F.lit('{"eventTime":"'), F.when(_every(50, 0), "not-a-time").otherwise(F.col("iso")),
        F.lit('","eventID":"'), "eid",
        F.lit('","awsRegion":"'), F.when(_every(90, 5), "").otherwise(F.col("rg")),
        F.lit('","userIdentity":{"accountId":"'), F.when(no_account, "").otherwise(F.col("acct")),
        F.lit('"}'), recipient, F.lit("}"))
    return F.when(_every(70, 3), F.concat(F.lit('{"eventID":"'), "eid")).otherwise(whole)


def audit(spark: SparkSession, sf_dir: str, dense: bool = False, copies: int = 1) -> DataFrame:
    """Records as both trails deliver them; one event in ten reaches both.

    With `copies`, each event stands for so many with numbers and ids of their own.
    """
    base = _base(spark, sf_dir, dense)
    if copies > 1:
        shift = F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("_copy")
        many = base.select("*", shift).withColumn("i", F.col("i") * copies + F.col("_copy")).drop("_copy")
        base = many.withColumn("eid", F.md5(F.col("i").cast("string")))
    base = base.withColumn("raw", _raw())
    copies = F.when(_every(10, 4), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    names = F.when(F.col("trail_rank") == 0, TRAILS[0].name).otherwise(TRAILS[1].name)
    return base.withColumn("trail_rank", F.explode(copies)).withColumn("trail", names)


_written: dict[tuple[str, str, str], str] = {}


def once(spark: SparkSession, sf_dir: str, what: str, make) -> str:
    """The folder `make(path)` filled, made at the first call of the application."""
    key = (spark.sparkContext.applicationId, sf_dir, what)
    if key not in _written:
        path = scratch(spark, what)
        make(path)
        _written[key] = path
    return _written[key]


def audit_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An object inventory table: one object per account, region and hour."""
    path = once(spark, sf_dir, "inventory", lambda at: _listing(spark, sf_dir).write.parquet(at))
    return spark.read.parquet(path)


def _listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    in_org = F.col("acct") <= "000000000003"
    stamp = F.concat(F.replace(F.substring("hr", 1, 10), F.lit("-"), F.lit("")), F.lit("T"),
                     F.substring("hr", 12, 2), F.lit("00Z"))
    day = F.replace(F.substring("hr", 1, 10), F.lit("-"), F.lit("/"))
    suffix = F.when(F.pmod(F.substring("hr", 9, 2).cast("int"), F.lit(9)) == 0, ".json.gz.tmp").otherwise(".json.gz")
    hours = (_base(spark, sf_dir).groupBy("acct", "rg", F.substring("iso", 1, 13).alias("hr"))
             .agg(F.count(F.lit(1)).alias("n_records")))
    key = F.concat(
        F.when(in_org, "logs/").otherwise(""), F.lit("AWSLogs/"), F.when(in_org, ORG + "/").otherwise(""),
        "acct", F.lit("/CloudTrail/"), "rg", F.lit("/"), day, F.lit("/"), "acct", F.lit("_CloudTrail_"), "rg",
        F.lit("_"), stamp, F.lit("_"), F.substring(F.md5(F.concat("acct", "rg", stamp)), 1, 8), suffix)
    return hours.select(
        F.when(in_org, TRAILS[0].name).otherwise(TRAILS[1].name).alias("trail"),
        F.when(in_org, 0).otherwise(1).alias("trail_rank"),
        F.lit(BUCKET).alias("bucket"), F.when(in_org, "logs").otherwise("").alias("prefix"),
        key.alias("key"), "n_records")


def earlier(files_or_records: DataFrame, day) -> DataFrame:
    """What an earlier run saw: all data of the days before the split."""
    return files_or_records.filter(day < SPLIT_DAY)


def log_files(spark: SparkSession, sf_dir: str, dense: bool = False, copies: int = 1, block: int = BLOCK) -> DataFrame:
    """`(trail, acct, rg, block, key, body)`: log files of at most `BLOCK` events each.

    A cut-off record cannot stand inside a log file; there the id is a number.
    """
    record = F.when(_every(70, 3), F.concat(F.lit('{"eventID":'), F.col("i").cast("string"), F.lit("}"))).otherwise(F.col("raw"))
    rows = audit(spark, sf_dir, dense, copies).select("trail", "acct", "rg", "i", record.alias("raw"),
                                       F.floor(F.col("i") / block).alias("block"))
    in_org = F.col("trail") == TRAILS[0].name
    key = F.concat(
        F.when(in_org, f"logs/AWSLogs/{ORG}/").otherwise("AWSLogs/"), "acct", F.lit("/CloudTrail/"), "rg",
        F.lit("/2024/01/"), F.lpad(F.col("block").cast("string"), 10, "0"), F.lit(".json.gz"))
    ordered = F.array_sort(F.collect_list(F.struct("i", "raw")))
    return (rows.groupBy("trail", "acct", "rg", "block")
            .agg(F.concat(F.lit('{"Records":['), F.concat_ws(",", F.transform(ordered, lambda r: r["raw"])),
                          F.lit("]}")).alias("body"))
            .withColumn("key", key))


def _write_files(rows):
    """Write `(path, body, plain)` rows, which come to Python a few at a time; how many."""
    fs, folders, files = None, set(), 0
    for path, body, plain in rows:
        if fs is None:
            fs, at = pafs.FileSystem.from_uri(path)
            start = len(path) - len(at)
        at = path[start:]
        if (folder := posixpath.dirname(at)) not in folders:
            fs.create_dir(folder, recursive=True)
            folders.add(folder)
        data = body.encode()
        with fs.open_output_stream(at, compression=None) as out:
            out.write(data if plain else gzip.compress(data, 1))
        files += 1
    yield files


def write_log_files(files: DataFrame, root: str) -> int:
    """Write `(key, body[, plain])` below `root` from the tasks; how many files.

    The rows go to Python in pickled batches of a few MB: an Arrow batch would hold 10,000 whole bodies.
    """
    if "plain" not in files.columns:
        files = files.withColumn("plain", F.lit(False))
    at = files.select(F.concat(F.lit(f"{root}/{BUCKET}/"), "key").alias("path"), "body", "plain")
    return at.rdd.mapPartitions(_write_files).sum()


def _write_stored(spark: SparkSession, sf_dir: str, root: str, dense: bool) -> None:
    files = log_files(spark, sf_dir, dense).select("acct", "key", "body")
    names = F.when(F.col("acct") == "000000000003",
                   F.array("key", F.concat("key", F.lit(".tmp")))).otherwise(F.array("key"))
    write_log_files(files.withColumn("key", F.explode(names)), root)


def stored_logs(spark: SparkSession, sf_dir: str, dense: bool = False) -> str:
    """Root folder of the log files of `sf_dir`.

    Beside each file of account 3 lies an unfinished upload that no reader may touch.
    """
    return once(spark, sf_dir, "dense-logs" if dense else "logs", lambda root: _write_stored(spark, sf_dir, root, dense))


def replicated_logs(spark: SparkSession, sf_dir: str, records: int) -> tuple[str, int]:
    """Root folder of dense log files of about 5,000 records, and their number of events."""
    have = events(spark, sf_dir).count()
    copies = max(1, -(-records // have))

    def make(root):
        files = log_files(spark, sf_dir, dense=True, copies=copies, block=20 * BLOCK)
        write_log_files(files.select("key", "body"), root)
    return once(spark, sf_dir, f"replicated-{copies}", make), have * copies


def spoilt_logs(spark: SparkSession, sf_dir: str) -> str:
    """Root folder of dense log files; those of accounts 4 to 7 are spoilt, each account's in another way."""
    def make(root):
        files = log_files(spark, sf_dir, dense=True)
        a = F.col("acct")
        body = (F.when(a == "000000000004", F.expr("left(body, length(body) - 1)"))
                .when(a == "000000000006", "").when(a == "000000000007", '{"Records":"none"}').otherwise(F.col("body")))
        write_log_files(files.select("key", body.alias("body"), (a == "000000000005").alias("plain")), root)
    return once(spark, sf_dir, "spoilt", make)


def options_for(root: str, **changes) -> IngestOptions:
    return IngestOptions(bucket_uri=f"{root}/{{bucket}}", **changes)
