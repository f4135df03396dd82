"""Micro-batch jobs over one folder layout.

ingest: JSON messages -> raw CSV by arrival date
enrich: raw CSV -> processed Parquet by event date
load:   processed Parquet -> keyed target table
alerts: raw CSV -> fined events as JSON lines, or to a topic

Every job keeps its progress in a checkpoint. The trees that jobs write have a log of finished files, by which the next
job reads, so a restart neither loses nor doubles rows, in this stage or the next.
Of events with one key the latest ``timestamp`` wins, in whatever order they are loaded. Rows that
cannot be used go to the quarantine trees, never away.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.types import StructType

from roadlake.functions.drift import with_extras
from roadlake.functions.event_time import add_date_parts, add_event_time, coerce_times, stamp
from roadlake.functions.measures import nan_to_null
from roadlake.functions.records import decode_events
from roadlake.operators.alerts import overspeed_alerts
from roadlake.operators.changes import BUCKETS, apply_changes
from roadlake.operators.offsets import offset_ranges
from roadlake.operators.quality import split_decoded, with_violations
from roadlake.operators.upsert import Upserted, create_target, stage, upsert
from roadlake.schema import EVENT_COLS, PARTITION_COLS, PROCESSED_SCHEMA
from roadlake.session import no_rows, prepare
from roadlake.sinks.files import ROWS_PER_RAW_FILE, as_quarantined, dated_raw, raw_options, start_sink, write_quarantine
from roadlake.sinks.kafka import write_kafka
from roadlake.sources.processed import processed_stream, read_parquet_or_empty, read_processed_any_layout
from roadlake.sources.raw import CORRUPT, FILES_PER_TRIGGER, raw_stream
from roadlake.streaming.audit import audited

log = logging.getLogger(__name__)

# The pause between micro-batches of a continuous run, and between loads of the target.
TRIGGER = "1 minute"
LOAD_TRIGGER = "1 hour"
ALERT_TOPIC = "vehicle-alerts"
#: What tells the offsets of messages apart.
OFFSET_SOURCES = ("topic", "partition")
# What an alert file carries beside the alert's own fields.
ALERT_KEEP = ("event_time", *PARTITION_COLS)


@dataclass(frozen=True)
class Layout:
    """Where the stages meet. ``root`` may be any file system Spark can reach."""

    root: str

    @property
    def raw(self) -> str:
        return f"{self.root}/raw/vehicle"

    @property
    def ingested(self) -> str:
        """Raw files of the ingest job, which has the tree for itself."""
        return f"{self.root}/raw/ingested"

    @property
    def extras(self) -> str:
        return f"{self.root}/raw/extras"

    @property
    def offsets(self) -> str:
        return f"{self.root}/offsets"

    @property
    def audit(self) -> str:
        return f"{self.root}/audit"

    @property
    def processed(self) -> str:
        return f"{self.root}/processed/vehicle"

    @property
    def enriched(self) -> str:
        """Processed files of the enrich job, which has the tree for itself."""
        return f"{self.root}/processed/enriched"

    @property
    def target(self) -> str:
        return f"{self.root}/target/vehicle_data"

    @property
    def keyed(self) -> str:
        return f"{self.root}/target/keyed"

    @property
    def feed(self) -> str:
        return f"{self.root}/target/keyed_feed"

    @property
    def alerts(self) -> str:
        return f"{self.root}/alerts"

    @property
    def quarantine(self) -> str:
        return f"{self.root}/quarantine"

    def set_aside(self, stage_name: str) -> str:
        return f"{self.quarantine}/{stage_name}"

    def checkpoint(self, job: str) -> str:
        return f"{self.root}/checkpoints/{job}"

    @property
    def staging(self) -> str:
        return f"{self.root}/staging"

    @property
    def journal(self) -> str:
        return f"{self.root}/journal"

    def create(self, spark: SparkSession) -> None:
        """Make the folders that streams watch; a stream cannot start on a missing one."""
        nothing = no_rows(spark, PROCESSED_SCHEMA).write.mode("ignore").partitionBy(*PARTITION_COLS)
        for tree in (self.raw, self.ingested):
            nothing.csv(tree)
        for tree in (self.processed, self.enriched):
            nothing.parquet(tree)
        create_target(spark, self.target)


class Job:
    """Queries that make up a job, the main one first. It can be waited for and stopped like one query."""

    def __init__(self, *queries: StreamingQuery):
        self.queries = queries

    def awaitTermination(self) -> None:
        """Wait for all; when one fails, the others are stopped and the failure is raised."""
        try:
            for query in self._until_over():
                query.awaitTermination(1)
        except BaseException:
            self.stop()
            raise

    def _until_over(self) -> Iterator[StreamingQuery]:
        while any(q.isActive for q in self.queries):
            yield from [q for q in self.queries if q.isActive]
        yield from self.queries  # raises what one has failed with

    def stop(self) -> None:
        for query in self.queries:
            query.stop()

    def processAllAvailable(self) -> None:
        for query in self.queries:
            query.processAllAvailable()

    @property
    def isActive(self) -> bool:
        return any(q.isActive for q in self.queries)

    @property
    def recentProgress(self) -> list:
        return self.queries[0].recentProgress


def start_ingest(
    messages: DataFrame,
    layout: Layout,
    trigger: str | None = TRIGGER,
    rows_per_file: int = ROWS_PER_RAW_FILE,
    value: str = "value",
    keep_extras: bool = False,
    keep_offsets: bool = False,
) -> Job:
    """Decode messages and write raw files under the UTC date of arrival.

    The arrival time is the micro-batch's own timestamp, which the checkpoint records, so a batch
    repeated after midnight still goes to its first folder. Malformed messages are written by a query of their own, which reads
    the messages once more. So are, where asked for, the fields that the schema lacks, with the event's vehicle and time; and the ranges of
    offsets that were taken, from messages with ``topic``, ``partition`` and ``offset``.
    """
    prepare(messages.sparkSession)
    decoded = decode_events(
        messages.withColumn("arrived", F.current_timestamp()), value=value, keep=("arrived",)
    )
    malformed = F.col("decode_error").isNotNull()
    good = dated_raw(_counted(decoded, malformed).where(~malformed)).select(*EVENT_COLS, *PARTITION_COLS)
    # A micro-batch arrives on one day and raw files are small: tasks write what they read.
    main = start_sink(
        good, layout.ingested, "csv", layout.checkpoint("ingest"), _pace(trigger), PARTITION_COLS, [], raw_options(rows_per_file), "ingest"
    )
    queries = [main, _set_aside(split_decoded(decoded, value)[1], layout, "decode", trigger)]
    if keep_extras:
        more = with_extras(decoded.where(~malformed), value).where("extras is not null")
        dated = dated_raw(more.select("vehicle_id", "timestamp", "extras", "arrived")).drop("arrived")
        queries.append(start_sink(
            dated, layout.extras, "parquet", layout.checkpoint("extras"), _pace(trigger), PARTITION_COLS, [], name="extras"
        ))
    if keep_offsets:
        def note(batch: DataFrame, batch_id: int) -> None:
            # A batch that is repeated replaces what it has noted.
            offset_ranges(batch, OFFSET_SOURCES).write.mode("overwrite").parquet(f"{layout.offsets}/run={_query_id(batch)}-{batch_id:010d}")

        taken = messages.select(*OFFSET_SOURCES, "offset")
        queries.append(_start(taken, note, layout.checkpoint("offsets"), trigger, "offsets"))
    return Job(*queries)


def read_offsets(spark: SparkSession, layout: Layout) -> DataFrame:
    """Ranges of offsets that ingest has taken, for ``operators.offsets``."""
    schema = StructType.fromDDL("topic string, partition int, first bigint, last bigint, copies bigint")
    return read_parquet_or_empty(spark, layout.offsets, schema)


def start_enrich(
    spark: SparkSession,
    layout: Layout,
    trigger: str | None = TRIGGER,
    max_files: int = FILES_PER_TRIGGER,
    max_bytes: int | None = None,
    precision: str = "second",
    enforce_contract: bool = False,
    **options: str,
) -> Job:
    """Add event time and date parts to raw events and write processed Parquet.

    With ``enforce_contract`` events that break the domain contract are set aside as well. Rows set aside are written by a
    query of their own, which reads the raw files once more. Further ``options`` go to the file sources.
    """
    layout.create(prepare(spark))
    enriched = add_event_time(_raw(spark, layout, max_files, max_bytes, **options), precision)
    broken = F.col(CORRUPT).isNotNull()
    if enforce_contract:
        enriched = with_violations(enriched)
        broken = broken | (F.size("reasons") > 0)
    good = add_date_parts(_counted(enriched, broken).where(~broken)).select(*PROCESSED_SCHEMA.names)
    main = start_sink(
        good, layout.enriched, "parquet", layout.checkpoint("enrich"), _pace(trigger), PARTITION_COLS, name="enrich"
    )
    return Job(main, _set_aside(enriched.where(broken), layout, "enrich", trigger))


def _raw(spark: SparkSession, layout: Layout, max_files: int, max_bytes: int | None, **options: str) -> DataFrame:
    """What the ingest job has written, and raw files that others put beside it; the limits hold for each."""
    ingested = raw_stream(spark, layout.ingested, max_files, max_bytes, any_age=False, **options)
    return ingested.unionByName(raw_stream(spark, layout.raw, max_files, max_bytes, **options))


def _counted(rows: DataFrame, left_out: Column) -> DataFrame:
    """``rows``, of which each micro-batch reports how many it keeps and how many it leaves out."""
    flag = F.coalesce(left_out, F.lit(False))
    return rows.observe("counts", F.count_if(~flag).alias("rows"), F.count_if(flag).alias("left_out"))


def _set_aside(rows: DataFrame, layout: Layout, stage_name: str, trigger: str | None) -> StreamingQuery:
    aside = as_quarantined(rows, stage_name).drop("stage")
    return start_sink(
        aside, layout.set_aside(stage_name), "parquet", layout.checkpoint(f"{stage_name}-quarantine"), _pace(trigger), [],
        name=f"{stage_name}-quarantine",
    )


def start_alerts(
    spark: SparkSession,
    layout: Layout,
    trigger: str | None = TRIGGER,
    max_files: int = FILES_PER_TRIGGER,
    max_bytes: int | None = None,
    servers: str | None = None,
    topic: str = ALERT_TOPIC,
) -> Job:
    """Write an alert for every fined raw event, as JSON lines by event date or, given ``servers``, to a topic.

    Files are written once; a topic gets the alerts of a repeated batch again.
    """
    layout.create(prepare(spark))
    alerts = overspeed_alerts(add_event_time(_raw(spark, layout, max_files, max_bytes)), ALERT_KEEP)
    if servers is None:
        return Job(start_sink(alerts, layout.alerts, "json", layout.checkpoint("alerts"), _pace(trigger), PARTITION_COLS, name="alerts"))

    def write(batch: DataFrame, _: int) -> None:
        write_kafka(batch, servers, topic, batch.columns)

    return Job(_start(alerts, write, layout.checkpoint("alerts"), trigger, "alerts"))


def start_load(
    spark: SparkSession,
    layout: Layout,
    trigger: str | None = LOAD_TRIGGER,
    max_files: int | None = None,
    max_bytes: int | None = None,
) -> Job:
    """Merge processed files into the target as they appear.

    Each load reads and writes the touched days whole, twice with the journal, however few rows are new, so loads are
    made less often than the other jobs' batches.
    """
    layout.create(prepare(spark))
    loadable = load_frame(_processed(spark, layout, max_files, max_bytes), F.current_timestamp())

    def write(batch: DataFrame, batch_id: int) -> None:
        log.info("load %s: %s", batch_id, _merge_keyed(stage(batch, layout.staging), layout, f"{_query_id(batch)}-{batch_id:010d}"))

    return Job(_start(loadable, write, layout.checkpoint("load"), trigger, "load"))


def _processed(spark: SparkSession, layout: Layout, max_files: int | None, max_bytes: int | None) -> DataFrame:
    """What the enrich job has written, and processed files that others put beside it; the limits hold for each."""
    enriched = processed_stream(spark, layout.enriched, max_files, max_bytes, any_age=False)
    return enriched.unionByName(processed_stream(spark, layout.processed, max_files, max_bytes))


def start_keyed_load(
    spark: SparkSession,
    layout: Layout,
    trigger: str | None = LOAD_TRIGGER,
    max_files: int | None = None,
    max_bytes: int | None = None,
    buckets: int = BUCKETS,
) -> Job:
    """Like ``start_load``, into a table by day and bucket of the key, with a feed of what each load has inserted and updated.

    A load reads keys and digests of the folders it touches and writes those with a change, so it may be made more often. A repeated
    micro-batch changes nothing that it has changed before, and its part of the feed stays.
    """
    layout.create(prepare(spark))
    loadable = load_frame(_processed(spark, layout, max_files, max_bytes), F.current_timestamp())

    def write(batch: DataFrame, batch_id: int) -> None:
        run = f"{_query_id(batch)}-{batch_id:010d}"

        def set_aside(unkeyed: DataFrame) -> None:
            write_quarantine(unkeyed, f"{layout.set_aside('load')}/run=keyed-{run}", "load")

        done = apply_changes(batch, layout.keyed, layout.feed, run, buckets=buckets, keep_newer=True, on_unkeyed=set_aside)
        log.info("keyed load %s: %s", batch_id, done)

    return Job(_start(loadable, write, layout.checkpoint("keyed-load"), trigger, "keyed-load"))


def load_full(spark: SparkSession, layout: Layout, run_time: Column | None = None) -> Upserted:
    """Merge every processed row again, whatever earlier runs have loaded."""
    prepare(spark)
    run_time = F.current_timestamp() if run_time is None else run_time
    enriched, other = (read_processed_any_layout(spark, root) for root in (layout.enriched, layout.processed))
    return _merge_keyed(load_frame(enriched.unionByName(other), run_time), layout, "full-load")


def _merge_keyed(rows: DataFrame, layout: Layout, run: str) -> Upserted:
    """Merge the rows that have a key; the others would be added anew by every run."""

    def set_aside(unkeyed: DataFrame) -> None:
        write_quarantine(unkeyed, f"{layout.set_aside('load')}/run={run}", "load")

    return upsert(rows, layout.target, journal=layout.journal, on_unkeyed=set_aside, keep_newer=True)


def read_quarantine(spark: SparkSession, layout: Layout) -> DataFrame:
    """Rows that the jobs have set aside: ``row`` (JSON text) and ``stage``."""
    schema = StructType().add("row", "string")
    stages = [read_parquet_or_empty(spark, layout.set_aside(s), schema).withColumn("stage", F.lit(s)) for s in ("decode", "enrich", "load")]
    return reduce(DataFrame.unionByName, stages)


def load_frame(processed: DataFrame, run_time: Column) -> DataFrame:
    """Processed events as the target wants them: real timestamps, no NaN, an audit stamp.

    Date parts are left out: the upsert derives them from ``event_time``.
    """
    return stamp(nan_to_null(coerce_times(processed.drop(*PARTITION_COLS))), run_time)


def run_available(
    spark: SparkSession,
    layout: Layout,
    messages: DataFrame | None = None,
    rows_per_file: int = ROWS_PER_RAW_FILE,
    max_files: int = FILES_PER_TRIGGER,
    max_bytes: int | None = None,
    precision: str = "second",
    enforce_contract: bool = False,
) -> None:
    """One bounded run of all stages over whatever is new, each picking up where it last ended; its counts go to the audit table."""
    with audited(spark, layout.audit):
        if messages is not None:
            start_ingest(messages, layout, None, rows_per_file).awaitTermination()
        start_enrich(spark, layout, None, max_files, max_bytes, precision, enforce_contract).awaitTermination()
        start_load(spark, layout, None, max_bytes=max_bytes).awaitTermination()


def _pace(trigger: str | None) -> dict[str, object]:
    """``trigger`` is the pause between batches, None drains and stops."""
    return {"availableNow": True} if trigger is None else {"processingTime": trigger}


def _query_id(batch: DataFrame) -> str:
    """Kept in the checkpoint, so the same when a micro-batch is repeated."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")


def _start(rows: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, trigger: str | None, name: str) -> StreamingQuery:
    """Append-mode query that hands its batches to ``write``, which must bear being called again with the same one."""

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            log.info("%s: batch %s has no rows", name, batch_id)
        else:
            write(batch, batch_id)

    writer = rows.writeStream.foreachBatch(on_batch).queryName(name).option("checkpointLocation", checkpoint)
    return writer.outputMode("append").trigger(**_pace(trigger)).start()
