"""Headline queries on the tables of $BENCH_SF_DIR; prints one JSON line.

Beside the queries it times the engine on dense hours: $BENCH_DENSE_RECORDS events (by default a
million) in files of some thousands, as scan and classify, dedup, and a whole ingest.
"""

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)

from auditlake import ingest_batch, operators as op, sources as src  # noqa: E402
from auditlake.session import RECOMMENDED, scratch  # noqa: E402
from workload import derive  # noqa: E402
from workload.queries import queries  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = os.environ.get("BENCH_CPUS", "8")
DENSE_RECORDS = int(os.environ.get("BENCH_DENSE_RECORDS", "1000000"))
HEADLINE = [
    "discover_account_regions", "pending_objects", "advance_checkpoints", "checkpoint_marks",
    "scan_records", "minimal_projection", "event_times", "reject_reasons", "route_counts",
    "dedup_first", "mark_duplicates", "drop_seen", "bloom_dedup", "file_assignment", "run_metrics",
    "write_read_back", "ingest_batch", "stream_dedup",
]


def session() -> SparkSession:
    builder = (SparkSession.builder.master(f"local[{CPUS}]").appName("auditlake-bench")
               .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
               .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="auditlake-bench-"))
               .config("spark.driver.memory", "12g").config("spark.sql.shuffle.partitions", CPUS))
    for k, v in RECOMMENDED.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    # Checksum files double the cost of the many small hour files on a local disk.
    spark._jvm.org.apache.hadoop.fs.FileSystem.getLocal(spark._jsc.hadoopConfiguration()).setWriteChecksum(False)
    return spark


def timed(run) -> float:
    started = time.perf_counter()
    run().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def dense_rates(spark: SparkSession) -> dict[str, int]:
    """Records per second of the dense set."""
    logs, events = derive.replicated_logs(spark, SF_DIR, DENSE_RECORDS)
    bucket = f"{logs}/{derive.BUCKET}"

    def classified():
        found = src.explode_records(src.read_log_files(spark, bucket))
        return op.classify_records(found.withColumn("trail_rank", F.lit(0)).withColumnRenamed("path", "key"))

    records = classified().count()
    runs = {
        "scan_classify": classified,
        "dedup": lambda: op.dedup_first(classified().filter("reject_reason is null").select(
            "event_id", "trail_rank", "key", "ordinal", "account_id", "event_micros")),
        "ingest": lambda: ingest_batch(spark, derive.TRAILS, scratch(spark, "lake"), derive.options_for(logs)),
    }
    rates = {name: round(records / timed(run)) for name, run in runs.items()}
    return {"events": events, "records": records, **{f"{k}_records_per_second": v for k, v in rates.items()}}


def main() -> None:
    spark = session()
    # Inputs that Spark derives from the tables are not part of any query's time.
    derive.stored_logs(spark, SF_DIR)
    events = derive.events(spark, SF_DIR).count()
    derive.audit_files(spark, SF_DIR).count()
    known = queries()
    for name in ("dedup_first", "scan_records"):
        timed(lambda: known[name](spark, SF_DIR))
    seconds = {name: round(timed(lambda: known[name](spark, SF_DIR)), 3) for name in HEADLINE}
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": float(os.path.basename(SF_DIR).removeprefix("sf") or 0),
        "events": events, "ingest_events_per_second": round(events / seconds["ingest_batch"]),
        "dense": dense_rates(spark) if DENSE_RECORDS else {},
    }))
    spark.stop()


if __name__ == "__main__":
    main()
