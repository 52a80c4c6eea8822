"""One Spark query per operator, over the whole tables."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auditlake import functions as fn
from auditlake import operators as op
from auditlake import sources as src
from auditlake import streaming as st
from auditlake.functions.paths import bare_path
from auditlake.plans import ingest as plan, ingest_batch
from auditlake.schemas import PAIR, ROUTE
from auditlake.session import scratch
from auditlake.sinks import merge_hours, write_events, write_layer, write_seen
from auditlake.sources.known_ids import layer_of
from auditlake.sources.listing import distinct_objects

from . import derive as d

PLACE = ("trail_rank", "i")
BLOOM = (100_000, 0.001)


def _yes_no(c, yes="yes", no="no"):
    return F.when(c, yes).otherwise(no)


def _classified(spark, sf_dir) -> DataFrame:
    return op.classify_records(d.audit(spark, sf_dir))


def _good(spark, sf_dir) -> DataFrame:
    return _classified(spark, sf_dir).filter(F.col("reject_reason").isNull()).withColumn("route", fn.route_key())


def _firsts(spark, sf_dir) -> DataFrame:
    return op.dedup_first(_good(spark, sf_dir), PLACE)


def _seen(spark, sf_dir) -> DataFrame:
    good = _good(spark, sf_dir).withColumn("event_date", F.concat_ws("-", "year", "month", "day"))
    return d.earlier(good, F.col("day")).select("event_id", "event_date").distinct()


def _logs(spark, sf_dir) -> DataFrame:
    return op.log_objects(d.audit_files(spark, sf_dir))


def _checkpoints(spark, sf_dir) -> DataFrame:
    early = d.earlier(_logs(spark, sf_dir), F.regexp_extract("key", r"/\d{4}/\d{2}/(\d{2})/", 1))
    return op.advance_checkpoints(early.filter(F.col("account_id") <= "000000000005"))


# Paths and listing

def base_prefixes(spark, sf_dir):
    return (d.audit_files(spark, sf_dir).groupBy("trail", "prefix", fn.base_prefix("prefix").alias("base"))
            .agg(F.count(F.lit(1)).alias("objects")))


def search_prefixes(spark, sf_dir):
    o = fn.parse_object_key(d.audit_files(spark, sf_dir)).withColumn("base", fn.base_prefix("prefix"))
    below = F.startswith("key", fn.search_prefix("base", "org_id", "account_id", "region"))
    return (o.groupBy(fn.search_prefix("base", "org_id", "account_id").alias("account_prefix"), "region")
            .agg(F.count_if(below).alias("objects_below")))


def parse_object_keys(spark, sf_dir):
    return fn.parse_object_key(d.audit_files(spark, sf_dir)).select("key", "org_id", "account_id", "region")


def account_ids(spark, sf_dir):
    return d.audit(spark, sf_dir).select(
        "acct", "eid", _yes_no(fn.is_account_id("acct")).alias("acct_ok"),
        _yes_no(fn.is_account_id(F.substring("eid", 1, 12))).alias("eid_ok"))


def state_keys(spark, sf_dir):
    return (fn.parse_object_key(d.audit_files(spark, sf_dir)).groupBy(fn.state_key().alias("state_key"))
            .agg(F.count(F.lit(1)).alias("objects")))


def discover_accounts(spark, sf_dir):
    return op.discover_accounts(d.audit_files(spark, sf_dir))


def discover_account_regions(spark, sf_dir):
    return op.discover_account_regions(d.audit_files(spark, sf_dir))


def list_log_objects(spark, sf_dir):
    root = d.stored_logs(spark, sf_dir)
    return src.list_objects(spark, d.TRAILS, d.options_for(root)).select("trail", "bucket", "key")


def distinct_listing(spark, sf_dir):
    files = d.audit_files(spark, sf_dir)
    again = files.withColumns({"trail": F.lit("second-trail"), "trail_rank": F.lit(9)})
    return distinct_objects(files.unionByName(again)).select("bucket", "key", "trail", "n_records")


# Records

def scan_records(spark, sf_dir):
    root = d.stored_logs(spark, sf_dir)
    found = src.read_log_files(spark, f"{root}/{d.BUCKET}")
    key = fn.object_key("path", f"{root}/{d.BUCKET}")
    trail = F.when(F.startswith("key", F.lit("logs/")), d.TRAILS[0].name).otherwise(d.TRAILS[1].name)
    return (src.explode_records(found).withColumn("key", key)
            .select(trail.alias("trail"), "key", F.col("ordinal").cast("bigint").alias("ordinal"), "raw"))


def minimal_projection(spark, sf_dir):
    return fn.project_minimal(d.audit(spark, sf_dir)).select(
        "trail", "i", "event_time", "event_id", "region", "identity_account_id", "recipient_account_id",
        _yes_no(F.col("malformed")).alias("malformed")).withColumns({
            # What a cut-off record left behind is of no use.
            c: F.when(F.col("malformed") == "yes", "").otherwise(F.col(c))
            for c in ("event_time", "event_id", "region", "identity_account_id", "recipient_account_id")})


def resolve_account(spark, sf_dir):
    return fn.resolve_account(fn.project_minimal(d.audit(spark, sf_dir))).select("trail", "i", "account_id")


def event_times(spark, sf_dir):
    timed = fn.parse_event_time(fn.project_minimal(d.audit(spark, sf_dir)))
    path = F.when(F.col("time_ok"), fn.route_key(("year", "month", "day", "hour")))
    return timed.select("trail", "i", "event_micros", path.alias("hour_path"))


def route_counts(spark, sf_dir):
    return _good(spark, sf_dir).groupBy("route").agg(F.count(F.lit(1)).alias("events"))


def reject_reasons(spark, sf_dir):
    c = _classified(spark, sf_dir)
    return (c.groupBy("trail", F.coalesce("reject_reason", F.lit("ok")).alias("outcome"))
            .agg(F.count(F.lit(1)).alias("events")))


# Dedup

def dedup_first(spark, sf_dir):
    return _firsts(spark, sf_dir).select("trail", "i", "event_id", "raw", "copies")


def mark_duplicates(spark, sf_dir):
    marked = op.mark_duplicates(_good(spark, sf_dir), PLACE)
    return marked.select("trail", "i", "event_id", _yes_no(F.col("is_duplicate"), "repeat", "first").alias("mark"))


def drop_seen(spark, sf_dir):
    left = op.drop_seen(_good(spark, sf_dir), _seen(spark, sf_dir), PLACE)
    return left.select("trail", "i", "event_id", "raw")


def drop_seen_by_date(spark, sf_dir):
    good = _good(spark, sf_dir).withColumn("event_date", F.concat_ws("-", "year", "month", "day"))
    left = op.drop_seen(good, _seen(spark, sf_dir), PLACE, prune_by_date=True)
    return left.select("trail", "i", "event_id", "raw")


def union_trails(spark, sf_dir):
    good = _good(spark, sf_dir)
    trails = [good.filter(F.col("trail") == t.name) for t in d.TRAILS]
    return op.dedup_first(op.union_trails(*trails), PLACE).select("event_id", "trail", "i")


def bloom_members(spark, sf_dir):
    good = _good(spark, sf_dir).select("event_id").distinct()
    sketch = op.bloom_build(good, *BLOOM)
    strangers = good.select("event_id", F.concat(F.lit("not-"), "event_id").alias("other"))
    both = good.select("event_id", F.lit(True).alias("member")).unionByName(
        strangers.select(F.col("other").alias("event_id"), F.lit(False).alias("member")))
    found = op.bloom_probe(both, sketch, *BLOOM, unique=True)
    false = F.count_if(~F.col("member") & F.col("maybe_seen"))
    return found.agg(
        F.count_if("member").alias("ids"), F.count_if(F.col("member") & F.col("maybe_seen")).alias("found"),
        _yes_no(false <= 0.002 * F.count_if("member") + 5).alias("few_false"))


def bloom_merge(spark, sf_dir):
    good = _good(spark, sf_dir)
    early, late = good.filter(F.col("day") < d.SPLIT_DAY), good.filter(F.col("day") >= d.SPLIT_DAY)
    sketch = op.bloom_merge(op.bloom_build(early, *BLOOM), op.bloom_build(late, *BLOOM))
    found = op.bloom_probe(good.select("event_id").distinct(), sketch, *BLOOM, unique=True)
    return found.agg(F.count(F.lit(1)).alias("ids"), F.count_if("maybe_seen").alias("found"))


def bloom_dedup(spark, sf_dir):
    """The sketch lets most new ids pass; only the rest is compared exactly."""
    seen = _seen(spark, sf_dir)
    probed = op.bloom_probe(_firsts(spark, sf_dir), op.bloom_build(seen, *BLOOM), *BLOOM, unique=True).alias("p")
    known = seen.select(F.col("event_id").alias("_id"))
    left = probed.join(known, F.col("maybe_seen") & (F.col("event_id") == F.col("_id")), "left_anti")
    return left.select("trail", "i", "event_id", "raw")


# Checkpoints

def pending_objects(spark, sf_dir):
    pending = op.pending_objects(_logs(spark, sf_dir), _checkpoints(spark, sf_dir))
    return pending.select("key", "account_id", "region", "n_records")


def advance_checkpoints(spark, sf_dir):
    return op.advance_checkpoints(_logs(spark, sf_dir)).drop("last_updated")


def merge_checkpoints(spark, sf_dir):
    old = _checkpoints(spark, sf_dir)
    new = op.advance_checkpoints(op.pending_objects(_logs(spark, sf_dir), old))
    return op.merge_checkpoints(old, new).drop("last_updated")


def checkpoint_marks(spark, sf_dir):
    marks = op.checkpoint_marks(_logs(spark, sf_dir))
    return marks.withColumn("is_last", _yes_no(F.col("is_last")))


# Sinks and counters

def file_assignment(spark, sf_dir):
    files = op.assign_file_no(_firsts(spark, sf_dir), 2, place=PLACE)
    return files.select("route", "event_id", "file_no", "file_name")


def write_read_back(spark, sf_dir):
    root = scratch(spark, "lake")
    write_events(_firsts(spark, sf_dir), f"{root}/events/run_id=1", 100)
    return src.read_events(spark, root, ["1"]).select("value", *ROUTE)


def run_metrics(spark, sf_dir):
    c = _classified(spark, sf_dir).withColumn(
        "group", F.coalesce("reject_reason", F.concat(F.lit("id:"), "event_id")))
    groups = (c.groupBy("group").agg(F.min(F.struct("trail_rank", "i", "reject_reason", *ROUTE)).alias("g"),
                                     F.count(F.lit(1)).alias("copies"))
              .select("g.*", "copies", F.lit(False).alias("is_seen")))
    n = F.col("n_records")
    files = _logs(spark, sf_dir).select(n.alias("size"), (n >= 3).alias("failed"), (n != 4).alias("downloaded"),
                                        F.when(n == 1, 1).otherwise(0).alias("attempts"))
    return op.run_metrics(groups, files).drop("jsonl_files")


def metric_rates(spark, sf_dir):
    counted = _logs(spark, sf_dir).groupBy("account_id", "region").agg(
        F.count(F.lit(1)).alias("files_downloaded"), F.sum("n_records").alias("events_processed"),
        (F.sum("n_records") * 4096).alias("bytes_downloaded")).withColumn("elapsed_seconds", F.lit(8.0))
    rates = fn.add_rates(counted)
    return rates.select("account_id", "region", *[
        F.floor(F.col(c) * 1000).alias(c) for c in ("download_rate", "event_rate", "mib_per_second")])


def reject_files(spark, sf_dir):
    root = d.spoilt_logs(spark, sf_dir)
    bucket = f"{root}/{d.BUCKET}"
    listed = src.list_objects(spark, d.TRAILS, d.options_for(root)).select("key")
    read = src.read_log_files(spark, bucket).select(fn.object_key("path", bucket).alias("key"), "_corrupt")
    bad = op.reject_files(listed, read)
    return (listed.join(bad.withColumn("bad", F.lit(True)), "key", "left")
            .select("key", _yes_no(F.col("bad").isNotNull(), "bad", "good").alias("state")))


# The whole ingest

def _routes(lines: DataFrame) -> DataFrame:
    return lines.groupBy(fn.route_key().alias("route")).agg(F.count(F.lit(1)).alias("events"))


def _ingested(spark, sf_dir) -> str:
    """The tables of one full ingest, shared by the queries that look at them."""
    logs = d.stored_logs(spark, sf_dir)
    return d.once(spark, sf_dir, "lake", lambda root: ingest_batch(spark, d.TRAILS, root, d.options_for(logs)))


def ingest(spark, sf_dir):
    return _routes(src.read_events(spark, _ingested(spark, sf_dir)))


def ingest_counters(spark, sf_dir):
    names = ["events_processed", "events_written", "events_duplicate", "events_malformed", "events_bad_time",
             "events_no_account", "hour_buffers", "files_listed", "files_processed", "errors"]
    return src.read_metrics(spark, _ingested(spark, sf_dir)).select(*names)


def ingest_checkpoints(spark, sf_dir):
    return src.read_checkpoints(spark, _ingested(spark, sf_dir)).select(*PAIR, "last_processed_key", "files_processed")


def ingest_incremental(spark, sf_dir):
    """The organization's trail first; then both, where only the second is new."""
    logs, root = d.stored_logs(spark, sf_dir), scratch(spark, "lake")
    ingest_batch(spark, d.TRAILS[:1], root, d.options_for(logs))
    ingest_batch(spark, d.TRAILS, root, d.options_for(logs))
    return _routes(src.read_events(spark, root))


def _streamed(spark, sf_dir) -> str:
    logs = d.stored_logs(spark, sf_dir)
    options = d.options_for(logs, late="file_log", max_files=5000)
    return d.once(spark, sf_dir, "stream-lake", lambda root: st.stream_ingest(
        spark, d.TRAILS, root, scratch(spark, "stream"), options, once=True).awaitTermination())


def stream_ingest(spark, sf_dir):
    return _routes(src.read_events(spark, _streamed(spark, sf_dir)))


def stream_checkpoint_table(spark, sf_dir):
    table = st.checkpoint_table(spark, _streamed(spark, sf_dir))
    return table.select(*PAIR, "last_processed_key", "files_processed")


def stream_resume(spark, sf_dir):
    """Two runs of one stream; the files of the second sort before those of the first."""
    files = d.log_files(spark, sf_dir)
    logs, out, state = scratch(spark, "logs"), scratch(spark, "records"), scratch(spark, "stream")
    in_org = F.startswith("key", F.lit("logs/"))
    for part in (in_org, ~in_org):
        d.write_log_files(files.filter(part).select("key", "body"), logs)
        records = src.explode_records(st.stream_log_files(spark, f"{logs}/{d.BUCKET}"))
        (records.select("path", "raw").writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination())
    back = spark.read.schema("path string, raw string").parquet(out)
    account = F.regexp_extract("path", r"AWSLogs/(?:o-[^/]*/)?([^/]+)/CloudTrail/", 1)
    return back.groupBy(account.alias("account_id")).agg(F.count(F.lit(1)).alias("records"))


def stream_dedup(spark, sf_dir):
    logs, out, state = d.stored_logs(spark, sf_dir), scratch(spark, "events"), scratch(spark, "stream")
    events = st.stream_dedup(st.stream_events(st.stream_log_files(spark, f"{logs}/{d.BUCKET}", 10_000)))
    # Hours are small here.
    st.stream_write(events, f"{out}/events/run_id=1", state, once=True, spread=1).awaitTermination()
    return _routes(src.read_events(spark, out, ["1"]))


def stream_progress(spark, sf_dir):
    """Files per pair and the ids in the state of a declarative stream, read from its checkpoint folder."""
    logs, out, state = d.stored_logs(spark, sf_dir, dense=True), scratch(spark, "events"), scratch(spark, "stream")
    events = st.stream_dedup(st.stream_events(st.stream_log_files(spark, f"{logs}/{d.BUCKET}", 50)))
    st.stream_write(events, f"{out}/events/run_id=1", state, once=True, spread=1).awaitTermination()
    held = st.stream_state(spark, state).agg(F.min("state_rows").alias("state_ids"))
    pairs = st.stream_checkpoints(spark, state, d.TRAILS, d.options_for(logs))
    return pairs.select(*PAIR, "last_processed_key", "files_processed").join(F.broadcast(held))


# Runs that must not lose anything; on the dense set, whose hour folders are few

def _dense(spark, sf_dir, **changes):
    return d.options_for(d.stored_logs(spark, sf_dir, dense=True), **changes)


def ingest_approx_resized(spark, sf_dir):
    """The sketch is asked for another size between the runs."""
    root = scratch(spark, "lake")
    ingest_batch(spark, d.TRAILS[:1], root, _dense(spark, sf_dir, bloom_items=1000))
    ingest_batch(spark, d.TRAILS, root, _dense(spark, sf_dir, bloom_items=100_000))
    return _routes(src.read_events(spark, root))


def ingest_approx_overfull(spark, sf_dir):
    """The first run brings many times the ids that the sketch was made for."""
    root = scratch(spark, "lake")
    for trails in (d.TRAILS[:1], d.TRAILS):
        ingest_batch(spark, trails, root, _dense(spark, sf_dir, bloom_items=50))
    return _routes(src.read_events(spark, root))


def ingest_rebucketed(spark, sf_dir):
    """Each run deals its ids to another number of folders; the last one brings all files once more."""
    root = scratch(spark, "lake")
    ingest_batch(spark, d.TRAILS[:1], root, _dense(spark, sf_dir, id_buckets=4))
    ingest_batch(spark, d.TRAILS, root, _dense(spark, sf_dir, id_buckets=64, compact_every=2))
    last = _dense(spark, sf_dir, id_buckets=16, dedup="exact")
    again = src.list_objects(spark, d.TRAILS, last).withColumn("bucket", F.lit("again"))
    ingest_batch(spark, [], root, last, objects=again)
    return _routes(src.read_events(spark, root))


def merged_hours(spark, sf_dir):
    """Hours that several runs brought events of, merged into files of 20 events at most."""
    root, options = scratch(spark, "lake"), _dense(spark, sf_dir, max_files=40, events_per_file=20)
    ingest_batch(spark, d.TRAILS, root, options)
    merge_hours(spark, root, options)
    files = src.event_files(spark, root).groupBy(fn.route_key().alias("route")).agg(F.count(F.lit(1)).alias("files"))
    return _routes(src.read_events(spark, root)).join(files, "route")


def loser_bitmaps(spark, sf_dir):
    """Records of each log file, and those left once the copies of other files have gone."""
    options = _dense(spark, sf_dir)
    path = scratch(spark, "losers")
    plan.numbered_files(op.log_objects(src.list_objects(spark, d.TRAILS, options))).write.parquet(f"{path}/files")
    files = spark.read.parquet(f"{path}/files")
    read = plan.opened(spark, files)
    rows = plan.narrow_rows(plan.scan_records(read, files), options)
    groups = plan.group_rows(rows).withColumn("is_seen", F.lit(False))
    losers = op.loser_bitmaps(plan.losing_records(rows, groups))
    marked = files.join(losers, "file_no", "left").select(bare_path("path").alias("_at"), "key", "losers")
    left = op.without_losers(F.col("Records"), F.col("losers"))
    return (read.join(marked, "_at").select("key", F.size("Records").cast("bigint").alias("records"),
                                            F.size(left).cast("bigint").alias("left")))


def known_ids(spark, sf_dir):
    """Some ids asked of an id table that three runs wrote, each in its own number of folders."""
    root, seen = scratch(spark, "ids"), _seen(spark, sf_dir).withColumn("part", F.pmod(F.hash("event_id"), F.lit(3)))
    for i, slots in enumerate((4, 64, 16)):
        write_seen(seen.filter(F.col("part") == i), root, str(i), slots)
    good = _good(spark, sf_dir).withColumn("event_date", F.concat_ws("-", "year", "month", "day"))
    asked = good.filter(F.pmod("i", F.lit(97)) == 4).select("event_id", "event_date").distinct()
    return src.known_among(spark, root, ["0", "1", "2"], asked, ["event_id"])


def layered_sketch(spark, sf_dir):
    """Five runs write sketches of their own ids; four of them fit into one, and no id is missed."""
    root, good = scratch(spark, "layers"), _good(spark, sf_dir).select("event_id").distinct()
    path = scratch(spark, "ids")
    good.withColumn("run", F.pmod(F.hash("event_id"), F.lit(5))).write.parquet(path)
    ids = spark.read.parquet(path)
    for i in range(5):
        mine = ids.filter(F.col("run") == i)
        write_layer(layer_of(mine, mine.count(), *BLOOM), root, str(i))
    layers = src.known_layers(spark, root, list("01234"), *BLOOM)
    strangers = ids.select(F.concat(F.lit("not-"), "event_id").alias("event_id"), F.lit(False).alias("member"))
    both = ids.select("event_id", F.lit(True).alias("member")).unionByName(strangers)
    found = src.probe_layers(both, layers, BLOOM[1])
    return found.agg(
        F.count_if("member").alias("ids"), F.count_if(F.col("member") & F.col("maybe_seen")).alias("found"),
        _yes_no(F.count_if(~F.col("member") & F.col("maybe_seen")) <= 0.002 * len(layers) * F.count_if("member") + 5)
        .alias("few_false"))


def trails_from_table(spark, sf_dir):
    table = spark.createDataFrame([(t.name, t.bucket, t.prefix or None, i) for i, t in enumerate(d.TRAILS)],
                                  "name string, bucket string, prefix string, trail_rank int")
    root = scratch(spark, "lake")
    ingest_batch(spark, table, root, _dense(spark, sf_dir))
    return _routes(src.read_events(spark, root))


def ingest_file_counters(spark, sf_dir):
    """Over spoilt files: what is no gzip cannot be downloaded, what is no log cannot be processed."""
    root = scratch(spark, "lake")
    made = ingest_batch(spark, d.TRAILS, root, d.options_for(d.spoilt_logs(spark, sf_dir)))
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "part-*")
    written = files.load(f"{root}/events").select("path").count()
    return made.select("files_listed", "files_processed", "errors", "hour_buffers",
                       _yes_no(F.col("files_downloaded") <= F.col("files_listed")).alias("downloads_ok"),
                       _yes_no(F.col("jsonl_files") == written).alias("outputs_ok"))


def list_after_checkpoint(spark, sf_dir):
    """A listing that goes on behind the first key of each pair."""
    options = _dense(spark, sf_dir)
    first = op.log_objects(src.list_objects(spark, d.TRAILS, options)).groupBy(*PAIR).agg(
        F.min("key").alias("last_processed_key"))
    listed = op.log_objects(src.list_objects(spark, d.TRAILS, options, after=first))
    return op.pending_objects(listed, first).select("bucket", "key").distinct()


def stream_listed_late_keys(spark, sf_dir):
    """As `stream_late_keys`, by the source that keeps listing offsets, which lists no folder in full again."""
    files, logs, root = d.log_files(spark, sf_dir, dense=True), scratch(spark, "logs"), scratch(spark, "lake")
    state, early = scratch(spark, "stream"), F.col("block") == 0
    options = d.options_for(logs, max_files=60, listing="offsets")
    for part in (~early, early):
        d.write_log_files(files.filter(part).select("key", "body"), logs)
        st.drained(lambda: st.stream_ingest(spark, d.TRAILS, root, state, options, once=True))
    return _routes(src.read_events(spark, root))


def _streamed_parts(spark, sf_dir, parts, states, **changes):
    """The routes of streams, one for each part of the files, that run one after another on one lake."""
    files, logs, root = d.log_files(spark, sf_dir, dense=True), scratch(spark, "logs"), scratch(spark, "lake")
    made = {}
    for part, state in zip(parts, states):
        d.write_log_files(files.filter(part).select("key", "body"), logs)
        at = made.setdefault(state, scratch(spark, "stream"))
        st.stream_ingest(spark, d.TRAILS, root, at, d.options_for(logs, **changes), once=True).awaitTermination()
    return _routes(src.read_events(spark, root))


def stream_late_keys(spark, sf_dir):
    """The second run's files sort before the first one's, and a micro-batch holds few."""
    early = F.col("block") == 0
    return _streamed_parts(spark, sf_dir, (~early, early), ("one", "one"), max_files=60)


def stream_second_query(spark, sf_dir):
    """A second checkpoint folder on the same tables, under the same name."""
    in_org = F.col("trail") == d.TRAILS[0].name
    return _streamed_parts(spark, sf_dir, (in_org, ~in_org), ("one", "two"))


def stream_bad_files(spark, sf_dir):
    """The files of a stream that cannot be read, found by a query beside it."""
    root, out = d.spoilt_logs(spark, sf_dir), scratch(spark, "bad")
    bucket = f"{root}/{d.BUCKET}"
    st.stream_bad_files(spark, bucket, out, scratch(spark, "stream"), once=True).awaitTermination()
    return spark.read.parquet(out).select(fn.object_key("path", bucket).alias("key"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        base_prefixes, search_prefixes, parse_object_keys, account_ids, state_keys, discover_accounts,
        discover_account_regions, list_log_objects, scan_records, minimal_projection, resolve_account,
        event_times, route_counts, reject_reasons, dedup_first, mark_duplicates, drop_seen,
        drop_seen_by_date, union_trails, bloom_members, bloom_merge, bloom_dedup, pending_objects,
        advance_checkpoints, merge_checkpoints, checkpoint_marks, file_assignment, write_read_back,
        run_metrics, metric_rates, reject_files, ingest_counters, ingest_checkpoints, ingest_incremental,
        stream_ingest, stream_checkpoint_table, stream_resume, stream_dedup, ingest_approx_resized,
        ingest_approx_overfull, trails_from_table, ingest_file_counters, list_after_checkpoint, stream_late_keys,
        stream_second_query, stream_bad_files, ingest_rebucketed, loser_bitmaps, known_ids, layered_sketch,
        stream_listed_late_keys, merged_hours, stream_progress,
    )} | {"distinct_objects": distinct_listing, "ingest_batch": ingest}
