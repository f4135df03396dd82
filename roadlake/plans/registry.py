"""One runnable query per operator, over the whole ``events`` table.

Queries about sinks and streams write to a fresh folder under the shared directory and return
what they read back.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType, TimestampType

from roadlake.functions.drift import promoted, with_extras
from roadlake.functions.event_time import add_date_parts, add_event_time, coerce_times, stamp
from roadlake.functions.measures import nan_to_null, round_measures, speeding_fine
from roadlake.functions.records import decode_events, encode_events, unknown_fields
from roadlake.operators.alerts import overspeed_alerts, preview
from roadlake.operators.batching import assign_batches, batch_counts
from roadlake.operators.changes import apply_changes, read_feed, read_keyed
from roadlake.operators.closing import close_batches
from roadlake.operators.columns import conform, rename, require_columns, split_unfit, union_by_name
from roadlake.operators.dedupe import dedupe_latest
from roadlake.operators.keys import repeated_keys
from roadlake.operators.offsets import findings, offset_ranges
from roadlake.operators.quality import split_decoded, split_keyed, with_violations
from roadlake.operators.time_range import time_range
from roadlake.operators.upsert import read_target, stage, upsert
from roadlake.plans.telemetry import telemetry
from roadlake.schema import EVENT_COLS, EVENT_SCHEMA, KEY_COLS, PROCESSED_SCHEMA, TARGET_SCHEMA
from roadlake.session import prepare, scratch_path
from roadlake.sinks.files import LEFT_OUT, ROWS_PER_RAW_FILE, write_files, write_processed, write_raw
from roadlake.sources.processed import read_processed, read_processed_any_layout
from roadlake.sources.raw import read_raw
from roadlake.streaming.audit import audited, read_audit
from roadlake.streaming.jobs import (
    Layout,
    load_frame,
    load_full,
    run_available,
    start_alerts,
    start_enrich,
    start_ingest,
    start_keyed_load,
    start_load,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

DAY_SECONDS = 86_400
RESEND_AFTER_DAYS = 30
# Text, so that the session's zone is applied and not that of the Python process.
FIRST_LOAD = "2024-02-01 00:00:00"
SECOND_LOAD = "2024-03-02 00:00:00"
# Rows per raw file in queries whose subject is not the file size.
LARGE_FILE = 1_000_000


def _query(fn: Query) -> Query:
    """Register under the function's name; pin UTC and return zone-free timestamps."""

    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = fn(prepare(spark), sf_dir)
        zoned = [f.name for f in df.schema.fields if isinstance(f.dataType, TimestampType)]
        return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned}) if zoned else df

    QUERIES[fn.__name__] = run
    return run


def _layout(spark: SparkSession, label: str) -> Layout:
    return Layout(scratch_path(spark, label))


def _fill_raw(spark: SparkSession, sf_dir: str, root: str) -> None:
    """Raw files of all events, arrived at their own event time."""
    write_raw(add_event_time(telemetry(spark, sf_dir)), root, "event_time", LARGE_FILE)


def _first_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_event_time(telemetry(spark, sf_dir)).drop("event_id")


def _second_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events again: fined ones corrected in place, the others sent a month later."""
    later = F.when(F.col("fine") > 0, 0).otherwise(RESEND_AFTER_DAYS * DAY_SECONDS)
    sent = telemetry(spark, sf_dir).withColumns({"speed": F.col("speed") + 1, "timestamp": F.col("timestamp") + later})
    return add_event_time(sent).drop("event_id")


def _messages(spark: SparkSession, sf_dir: str, label: str) -> DataFrame:
    """All events as a stream of JSON messages, spread as over the partitions of a topic."""
    path = scratch_path(spark, label)
    partitions = spark.sparkContext.defaultParallelism
    encode_events(telemetry(spark, sf_dir)).repartition(partitions).write.parquet(path)
    return spark.readStream.schema("value string").parquet(path)


@_query
def q01_decode_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    schema = StructType().add("k", "integer")
    return split_decoded(decode_events(events, schema, "props", ("event_id",)), "props", ["k"])[0]


@_query
def q02_enrich_event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_event_time(telemetry(spark, sf_dir))


@_query
def q03_speed_fine(spark: SparkSession, sf_dir: str) -> DataFrame:
    fined = round_measures(telemetry(spark, sf_dir)).withColumn("fine", speeding_fine("speed"))
    return fined.select("event_id", "speed", "location_lat", "location_lon", "price_of_vechical", "fine")


@_query
def q04_overspeed_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overspeed_alerts(telemetry(spark, sf_dir), keep=("event_id",))


@_query
def q05_assign_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    enriched = add_event_time(telemetry(spark, sf_dir)).select("event_id", "event_time")
    return assign_batches(enriched, "event_time", ["event_id"], max_seconds=DAY_SECONDS)


@_query
def q06_batch_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch_counts(q05_assign_batches.__wrapped__(spark, sf_dir))


@_query
def q07_raw_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "q07")
    _fill_raw(spark, sf_dir, root)
    return read_raw(spark, root).select(*EVENT_COLS)


@_query
def q08_stream_csv_to_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout = _layout(spark, "q08")
    _fill_raw(spark, sf_dir, layout.raw)
    start_enrich(spark, layout, trigger=None).awaitTermination()
    return read_processed(spark, layout.enriched)


@_query
def q09_processed_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "q09")
    write_processed(add_event_time(telemetry(spark, sf_dir)), root)
    return read_processed(spark, root)


@_query
def q10_time_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "q10")
    write_processed(add_event_time(telemetry(spark, sf_dir)), root)
    return time_range(read_processed(spark, root), dt.datetime(2024, 1, 8, 6), dt.datetime(2024, 1, 15, 18, 30))


@_query
def q11_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preview(add_event_time(telemetry(spark, sf_dir)).orderBy("event_id"))


@_query
def q12_union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = telemetry(spark, sf_dir)
    positions = events.select("event_id", "vehicle_id", "location_lat", "location_lon")
    owners = events.select("phone_number", "vehicle_id", "event_id")
    return union_by_name([positions, owners, overspeed_alerts(events, keep=("event_id",)).drop("fine")])


@_query
def q13_coerce_event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    as_text = F.when(F.col("event_type") == "error", "garbage").otherwise(F.col("ts").cast("string"))
    as_number = F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(1e6)
    return coerce_times(events.select("event_id", as_number.alias("event_time"), as_text.alias("processing_time")))


@_query
def q14_null_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    beyond_sensor = F.when(F.col("speed") > 200, F.lit(float("nan"))).otherwise(F.col("speed"))
    return nan_to_null(telemetry(spark, sf_dir).withColumn("speed", beyond_sensor))


@_query
def q15_dedupe_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    enriched = add_event_time(telemetry(spark, sf_dir))
    return dedupe_latest(enriched, ["vehicle_id", "year", "month", "day"], ["timestamp"])


def _upserted(spark: SparkSession, sf_dir: str, label: str, times: int) -> DataFrame:
    path = scratch_path(spark, label)
    upsert(stamp(_first_load(spark, sf_dir), F.lit(FIRST_LOAD)), path)
    second = stage(stamp(_second_load(spark, sf_dir), F.lit(SECOND_LOAD)), scratch_path(spark, f"{label}-staging"))
    for _ in range(times):
        upsert(second, path)
    return read_target(spark, path)


@_query
def q16_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _upserted(spark, sf_dir, "q16", 1)


@_query
def q17_upsert_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _upserted(spark, sf_dir, "q17", 2)


@_query
def q18_stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout = _layout(spark, "q18")
    for load in (_first_load, _second_load):
        write_processed(load(spark, sf_dir), layout.processed)
        start_load(spark, layout, trigger=None).awaitTermination()
    return read_target(spark, layout.target).drop("last_updated")


@_query
def q19_quality_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = with_violations(telemetry(spark, sf_dir))
    return flagged.select(
        "event_id", (F.size("reasons") == 0).alias("accepted"), F.array_join("reasons", ",").alias("reasons")
    )


@_query
def q20_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = encode_events(telemetry(spark, sf_dir), keep=("event_id",))
    return split_decoded(decode_events(encoded, keep=("event_id",)))[0]


@_query
def q21_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each event ends up when some messages are cut short, empty, or lack a time."""
    events = telemetry(spark, sf_dir)
    no_time = F.when(F.col("speed") >= 1, F.col("timestamp"))
    message = (
        F.when(F.col("fine") > 0, F.expr("left(value, length(value) - 1)"))
        .when(F.col("vehicle_type") == "bike", F.col("value"))
        .when(F.col("speed") <= 100, F.col("value"))
    )
    sent = encode_events(
        events.withColumn("timestamp", no_time), keep=("event_id", "fine", "vehicle_type", "speed")
    ).select("event_id", message.alias("value"))
    decoded, malformed = split_decoded(decode_events(sent, keep=("event_id",)))
    keyed, unkeyed = split_keyed(add_event_time(decoded))
    return union_by_name([
        malformed.select("event_id", F.col("reason").alias("outcome")),
        unkeyed.select("event_id", F.lit("null_key").alias("outcome")),
        keyed.select("event_id", F.lit("loaded").alias("outcome")),
    ])


@_query
def q22_conform_to_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames of other types, another column order and a missing column, made to fit the target."""
    enriched = add_event_time(telemetry(spark, sf_dir)).drop("event_id", "price_of_vechical")
    loose = enriched.select(
        "event_time",
        F.when(F.col("fine") > 0, "n/a").otherwise(F.col("speed").cast("string")).alias("speed"),
        F.col("user_id").cast("bigint").alias("user_id"),
        *[c for c in enriched.columns if c not in ("event_time", "speed", "user_id")],
    )
    return conform(stamp(loose, F.lit(FIRST_LOAD)), TARGET_SCHEMA, required=["vehicle_id", "event_time"])


@_query
def q23_require_and_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    named = rename(events, {"ts": "event_time", "value": "speed", "no_such_column": "ignored"})
    return require_columns(named, ["event_id", "event_time", "speed"]).select("event_id", "event_time", "speed")


@_query
def q24_audit_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_frame(_first_load(spark, sf_dir), F.lit(FIRST_LOAD)).select("vehicle_id", "timestamp", "last_updated")


@_query
def q25_raw_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "q25")
    _fill_raw(spark, sf_dir, root)
    return read_raw(spark, root, dt.date(2024, 1, 10), dt.date(2024, 1, 20)).select(*EVENT_COLS)


@_query
def q26_partition_recovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One tree with cars filed by day and bikes by month only."""
    root = scratch_path(spark, "q26")
    enriched = add_event_time(telemetry(spark, sf_dir)).select(*PROCESSED_SCHEMA.names)
    is_car = F.col("vehicle_type") == "car"
    write_files(enriched.where(is_car), root, "parquet", ["year", "month", "day"])
    write_files(enriched.where(~is_car), root, "parquet", ["year", "month"])
    return read_processed_any_layout(spark, root).withColumn("day", F.col("day").cast("string"))


@_query
def q27_assign_batches_across_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """q05 with rows that arrive in no order, over many tasks."""
    enriched = add_event_time(telemetry(spark, sf_dir)).select("event_id", "event_time").repartition(23)
    return assign_batches(enriched, "event_time", ["event_id"], max_seconds=DAY_SECONDS)


@_query
def q28_stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw files of an ingest run: rows and sums of their contents, and files with more rows than allowed."""
    layout = _layout(spark, "q28")
    start_ingest(_messages(spark, sf_dir, "q28-messages"), layout, trigger=None).awaitTermination()
    files = spark.read.schema(EVENT_SCHEMA).option("header", "true").csv(layout.ingested)
    per_file = files.groupBy(F.input_file_name().alias("file")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("user_id").alias("users"),
        F.sum("fine").alias("fines"),
        F.sum(F.round(F.col("speed") * 100).cast("bigint")).alias("speeds"),
        F.sum(F.col("phone_number").cast("bigint")).alias("phones"),
    )
    return per_file.agg(
        F.sum("n").alias("n_rows"), F.count_if(F.col("n") > ROWS_PER_RAW_FILE).alias("files_too_large"),
        *[F.sum(c).cast("bigint").alias(c) for c in ("users", "fines", "speeds", "phones")],
    )


@_query
def q29_full_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages to target table through all three jobs."""
    layout = _layout(spark, "q29")
    run_available(spark, layout, _messages(spark, sf_dir, "q29-messages"), rows_per_file=LARGE_FILE)
    return read_target(spark, layout.target).drop("last_updated")


@_query
def q30_micro_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    exact = add_event_time(telemetry(spark, sf_dir), precision="micro")
    return add_date_parts(exact).select("event_id", "event_time", "year", "month", "day")


@_query
def q31_full_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both loads in one processed tree, merged whole and then once more."""
    layout = Layout(scratch_path(spark, "q31"))
    for load, run_time in ((_first_load, FIRST_LOAD), (_second_load, SECOND_LOAD)):
        write_processed(load(spark, sf_dir), layout.processed)
        load_full(spark, layout, F.lit(run_time))
    return read_target(spark, layout.target)


@_query
def q32_upsert_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same source twice, with rows whose key has a null: those match nothing."""
    path = scratch_path(spark, "q32")
    timed = F.when(F.col("speed") >= 1, F.col("timestamp"))
    source = add_event_time(telemetry(spark, sf_dir).withColumn("timestamp", timed)).drop("event_id")
    for _ in range(2):
        upsert(stamp(source, F.lit(FIRST_LOAD)), path)
    return read_target(spark, path).select("vehicle_id", "phone_number", "speed", "event_time")


@_query
def q33_stream_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enrichment that keeps only events which meet the contract."""
    layout = Layout(scratch_path(spark, "q33"))
    _fill_raw(spark, sf_dir, layout.raw)
    start_enrich(spark, layout, trigger=None, max_files=1000, enforce_contract=True).awaitTermination()
    return read_processed(spark, layout.enriched)


@_query
def q34_replay_across_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages ingested and enriched; then the record that each job has finished is lost, and both repeat their last batch."""
    layout = Layout(scratch_path(spark, "q34"))
    messages = _messages(spark, sf_dir, "q34-messages")
    for job in ("ingest", "enrich", None):
        start_ingest(messages, layout, None, LARGE_FILE).awaitTermination()
        start_enrich(spark, layout, trigger=None, max_files=1000).awaitTermination()
        if job is not None:
            commits = spark._jvm.org.apache.hadoop.fs.Path(f"{layout.checkpoint(job)}/commits")
            commits.getFileSystem(spark._jsc.hadoopConfiguration()).delete(commits, True)
    return read_processed(spark, layout.enriched)


@_query
def q35_load_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Later events are loaded first; earlier ones with the same keys then change nothing."""
    layout = Layout(scratch_path(spark, "q35"))
    events = telemetry(spark, sf_dir).drop("event_id")
    second = F.floor("timestamp").cast("double")
    for fraction, faster in ((0.9, 1), (0.1, 2)):
        changes = {"timestamp": second + fraction, "speed": F.col("speed") + faster}
        write_processed(add_event_time(events.withColumns(changes)), layout.processed)
        start_load(spark, layout, trigger=None).awaitTermination()
    return read_target(spark, layout.target).drop("last_updated")


@_query
def q36_decode_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events sent as bytes: good, twice in one message, with text after them, or with a field too many."""
    sent = encode_events(telemetry(spark, sf_dir), keep=("event_id",))
    body = F.col("value")
    value = (
        F.when(F.col("event_id") % 4 == 0, F.concat(body, F.lit(" "), body))
        .when(F.col("event_id") % 4 == 1, F.concat(body, F.lit(" junk}")))
        .when(F.col("event_id") % 4 == 2, F.concat(F.lit('{"colour":"red",'), F.expr("substr(value, 2)")))
        .otherwise(body)
    )
    decoded = decode_events(sent.select("event_id", F.encode(value, "UTF-8").alias("value")), keep=("event_id",))
    unknown = F.when(F.col("decode_error").isNull(), F.array_join(unknown_fields(), ","))
    return decoded.select("event_id", "vehicle_id", "decode_error", unknown.alias("unknown"))


def _awkward_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose vehicle names hold outer spaces, quotes, commas and line breaks."""
    name = (
        F.when(F.col("event_id") % 4 == 0, F.concat(F.lit("  "), F.col("vehicle_name"), F.lit(" ")))
        .when(F.col("event_id") % 4 == 1, F.concat(F.lit('"'), F.col("vehicle_name"), F.lit('", "x"')))
        .when(F.col("event_id") % 4 == 2, F.concat(F.col("vehicle_name"), F.lit("\nline, two")))
        .otherwise(F.col("vehicle_name"))
    )
    return telemetry(spark, sf_dir).withColumn("vehicle_name", name)


@_query
def q37_raw_csv_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Awkward names through raw files, once read as a table and once as a stream."""
    layout = Layout(scratch_path(spark, "q37"))
    write_raw(add_event_time(_awkward_names(spark, sf_dir)), layout.raw, "event_time", LARGE_FILE)
    start_enrich(spark, layout, trigger=None, max_files=1000).awaitTermination()
    columns = ["vehicle_id", "phone_number", "vehicle_name"]
    return read_raw(spark, layout.raw).select(*columns).unionByName(read_processed(spark, layout.enriched).select(*columns))


@_query
def q38_upsert_many_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """q16 with a source that is merged a few days at a time."""
    path = scratch_path(spark, "q38")
    upsert(stamp(_first_load(spark, sf_dir), F.lit(FIRST_LOAD)), path, slice_days=20)
    second = stage(stamp(_second_load(spark, sf_dir), F.lit(SECOND_LOAD)), scratch_path(spark, "q38-staging"))
    upsert(second, path, slice_days=20)
    return read_target(spark, path)


@_query
def q39_unfit_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which events are loaded when some hold text where a number belongs, or a fraction where a whole number does."""
    events = telemetry(spark, sf_dir)
    loose = events.withColumns({
        "speed": F.when(F.col("fine") > 0, "fast").otherwise(F.col("speed").cast("string")),
        "user_id": F.col("user_id") + F.when(F.col("vehicle_type") == "bike", 0.5).otherwise(0.0),
    })
    fit, unfit = split_unfit(loose, TARGET_SCHEMA)
    return fit.select("event_id", F.lit("loaded").alias("outcome"), F.lit(None).cast("string").alias("columns")).unionByName(
        unfit.select("event_id", F.lit("set aside").alias("outcome"), F.array_join("unfit", ",").alias("columns"))
    )


@_query
def q40_stream_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts that the alerts job writes from raw files."""
    layout = Layout(scratch_path(spark, "q40"))
    _fill_raw(spark, sf_dir, layout.raw)
    start_alerts(spark, layout, trigger=None, max_files=1000).awaitTermination()
    schema = "vehicle_id string, speed double, fine int, phone_number string, message string"
    return spark.read.schema(schema).json(layout.alerts).select("vehicle_id", "speed", "fine", "phone_number", "message")


@_query
def q41_observed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What writes and upserts report about their rows."""
    events = add_event_time(telemetry(spark, sf_dir))
    written = write_processed(events.withColumn(LEFT_OUT, F.col("fine") > 0), scratch_path(spark, "q41"))
    path = scratch_path(spark, "q41-target")
    first = upsert(stamp(_first_load(spark, sf_dir), F.lit(FIRST_LOAD)), path)
    second = upsert(stamp(_second_load(spark, sf_dir).where("fine > 0"), F.lit(SECOND_LOAD)), path)
    counts = {
        "written": written.rows, "left_out": written.left_out, "first_load": first.from_source,
        "second_load": second.from_source, "carried_over": second.carried_over,
    }
    # Counts of whole runs: five rows, whatever the table's size.
    return spark.range(1).select(F.explode(F.create_map(*[F.lit(x) for kv in counts.items() for x in kv])).alias("what", "n")).select(
        "what", F.col("n").cast("bigint").alias("n")
    )


@_query
def q42_other_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A processed tree in which files of another kind lie beside the Parquet ones."""
    root = scratch_path(spark, "q42")
    enriched = add_event_time(telemetry(spark, sf_dir)).select(*PROCESSED_SCHEMA.names)
    write_files(enriched, root, "parquet", ["year", "month", "day"])
    write_files(enriched.withColumn("event_time", F.col("event_time").cast("string")), root, "json", ["year", "month", "day"])
    return read_processed(spark, root)


@_query
def q43_files_per_trigger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Micro-batches of an enrich run that may take ten files at a time: none more, no file lost."""
    layout = Layout(scratch_path(spark, "q43"))
    _fill_raw(spark, sf_dir, layout.raw)
    files = read_raw(spark, layout.raw).select(F.input_file_name().alias("file")).distinct().count()
    job = start_enrich(spark, layout, trigger=None, max_files=10)
    job.awaitTermination()
    batches = sum(p["numInputRows"] > 0 for p in job.recentProgress)
    return read_processed(spark, layout.enriched).agg(F.count(F.lit(1)).alias("n_rows"), F.lit(files <= 10 * batches).alias("within_limit"))


@_query
def q44_closed_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches closed one after the other, by number or by age, in each partition of a topic; one partition has two thirds of the rows."""
    partition = F.least(F.col("event_id") % 6, F.lit(2)).alias("topic_partition")
    events = add_event_time(telemetry(spark, sf_dir)).select("event_id", "event_time", partition)
    return close_batches(events, ["topic_partition"], "event_time", ["event_id"], 56, DAY_SECONDS // 4)


def _third_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second load, and the events that it has not corrected sent once more as they were."""
    return _second_load(spark, sf_dir).unionByName(_first_load(spark, sf_dir).where("fine = 0"))


@_query
def q45_change_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a second load has inserted and updated, as the feed has it."""
    root = scratch_path(spark, "q45")
    apply_changes(stamp(_first_load(spark, sf_dir), F.lit(FIRST_LOAD)), f"{root}/table", f"{root}/feed", "first")
    apply_changes(stamp(_third_load(spark, sf_dir), F.lit(SECOND_LOAD)), f"{root}/table", f"{root}/feed", "second")
    return read_feed(spark, f"{root}/feed").where("run = 'second'").drop("run")


@_query
def q46_keyed_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table after both loads, the second one twice and in steps of a few folders."""
    root = scratch_path(spark, "q46")
    apply_changes(stamp(_first_load(spark, sf_dir), F.lit(FIRST_LOAD)), f"{root}/table", f"{root}/feed", "first", buckets=4)
    for run in ("second", "again"):
        load = stamp(_third_load(spark, sf_dir), F.lit(SECOND_LOAD))
        apply_changes(load, f"{root}/table", f"{root}/feed", run, buckets=4, listed=200)
    return read_keyed(spark, f"{root}/table")


@_query
def q47_change_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What loads report: all new, some changed, and nothing changed, for which no folder is written."""
    root = scratch_path(spark, "q47")
    loads = {"first": _first_load(spark, sf_dir), "second": _third_load(spark, sf_dir), "again": _third_load(spark, sf_dir)}
    rows = []
    for name, load in loads.items():
        done = apply_changes(stamp(load, F.lit(FIRST_LOAD)), f"{root}/table", f"{root}/feed", name, buckets=4)
        rows.append(F.struct(
            F.lit(name).alias("load"), *[F.lit(n).cast("bigint").alias(c) for c, n in done._asdict().items() if c not in ("stale", "folders")],
            F.lit(done.folders > 0).alias("rewrites"),
        ))
    # Counts of whole loads: three rows, whatever the table's size.
    return spark.range(1).select(F.inline(F.array(*rows)))


@_query
def q48_drifting_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose messages have fields beyond the schema, through a Parquet file and back."""
    more = F.when(F.col("fine") > 0, F.concat(F.lit('{"colour":"red","lane":'), F.col("user_id") % 4, F.lit(","))).when(
        F.col("vehicle_type") == "bike", '{"lane":"left","axles":{"n":2},'
    ).otherwise("{")
    sent = encode_events(telemetry(spark, sf_dir), keep=("event_id", "fine", "user_id", "vehicle_type"))
    path = scratch_path(spark, "q48")
    value = F.concat(more, F.expr("substr(value, 2)"))
    with_extras(decode_events(sent.select("event_id", value.alias("value")), keep=("event_id",))).write.parquet(path)
    kept = promoted(spark.read.parquet(path), {"colour": "string", "lane": "int", "axles": "string"})
    text = F.try_variant_get("extras", "$.lane", "string")
    return kept.select("event_id", "vehicle_id", "colour", "lane", text.alias("lane_text"), "axles")


@_query
def q49_offset_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a ledger of two batches says of a topic whose fast events are lost, while a stretch of it is taken by both."""
    events = telemetry(spark, sf_dir)
    messages = events.select(
        (F.col("event_id") % 3).alias("partition"), F.floor(F.col("event_id") / 3).alias("offset"), "speed"
    )
    first, second = messages.where("speed <= 150 AND offset % 1000 < 700"), messages.where("speed <= 150 AND offset % 1000 >= 600")
    ledger = offset_ranges(first, ["partition"]).unionByName(offset_ranges(second, ["partition"]))
    return findings(ledger, ["partition"])


@_query
def q50_audit_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows in, kept and set aside over all micro-batches of an ingest and an enrich run, as the audit table has them."""
    layout = _layout(spark, "q50")
    cut_short = F.when(F.col("fine") > 0, F.expr("left(value, length(value) - 1)")).otherwise(F.col("value"))
    path = scratch_path(spark, "q50-messages")
    encode_events(telemetry(spark, sf_dir), keep=("fine",)).select(cut_short.alias("value")).repartition(6).write.parquet(path)
    messages = spark.readStream.schema("value string").option("maxFilesPerTrigger", 2).parquet(path)
    with audited(spark, layout.audit):
        start_ingest(messages, layout, None, LARGE_FILE).awaitTermination()
        start_enrich(spark, layout, None, max_files=1000, enforce_contract=True).awaitTermination()
    noted = read_audit(spark, layout.audit).where(F.col("job").isin("ingest", "enrich"))
    return noted.groupBy("job").agg(*[F.sum(c).alias(c) for c in ("rows_in", "rows", "left_out")])


@_query
def q51_uneven_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A week from a tree with cars filed by day and bikes by month only; files of other days are not opened."""
    root = scratch_path(spark, "q51")
    enriched = add_event_time(telemetry(spark, sf_dir)).select(*PROCESSED_SCHEMA.names)
    is_car = F.col("vehicle_type") == "car"
    write_files(enriched.where(is_car), root, "parquet", ["year", "month", "day"])
    write_files(enriched.where(~is_car), root, "parquet", ["year", "month"])
    week = read_processed_any_layout(spark, root, first_day=dt.date(2024, 1, 8), last_day=dt.date(2024, 1, 14))
    return week.withColumn("day", F.col("day").cast("string"))


@_query
def q52_repeated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that a table without an upsert has more than once: fined events are there twice."""
    events = add_event_time(telemetry(spark, sf_dir)).drop("event_id")
    root = scratch_path(spark, "q52")
    write_processed(events.unionByName(events.where("fine > 0")), root)
    return repeated_keys(read_processed(spark, root), KEY_COLS)


@_query
def q53_downward_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row with the time of the table's row replaces it where its values are greater; a lower speed with the same time does not land."""
    layout = _layout(spark, "q53")
    events = telemetry(spark, sf_dir).drop("event_id")
    for change in (0, -1):
        write_processed(add_event_time(events.withColumn("speed", F.col("speed") + change)), layout.processed)
        start_load(spark, layout, trigger=None).awaitTermination()
    return read_target(spark, layout.target).drop("last_updated")


@_query
def q54_stream_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """q18 into the keyed table, the last load repeated as after a lost commit: how each row got there, and its values."""
    layout = _layout(spark, "q54")
    for n, load in enumerate((_first_load, _second_load)):
        write_processed(load(spark, sf_dir), layout.processed)
        start_keyed_load(spark, layout, trigger=None, buckets=2).awaitTermination()
        if n:
            commits = spark._jvm.org.apache.hadoop.fs.Path(f"{layout.checkpoint('keyed-load')}/commits")
            commits.getFileSystem(spark._jsc.hadoopConfiguration()).delete(commits, True)
            start_keyed_load(spark, layout, trigger=None, buckets=2).awaitTermination()
    last = F.when(F.col("run").endswith("1"), F.col("change"))
    changes = read_feed(spark, layout.feed).groupBy(*KEY_COLS).agg(F.count(F.lit(1)).alias("n_changes"), F.max(last).alias("in_last"))
    return read_keyed(spark, layout.keyed).drop("last_updated").join(changes, KEY_COLS)
