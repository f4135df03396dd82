"""Keyed upsert into a partitioned Parquet table.

The partition columns are functions of ``event_time``, which is part of the key, so a row can
only replace a row of its own partition. An upsert reads and rewrites the partitions its source
touches and leaves every other file alone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from roadlake.functions.event_time import add_date_parts
from roadlake.operators.columns import conform
from roadlake.operators.dedupe import dedupe_latest, fixed_width_first, split_on_null
from roadlake.schema import KEY_COLS, PARTITION_COLS, TARGET_SCHEMA
from roadlake.session import checkpointed, no_rows, scratch_path
from roadlake.sources.processed import read_parquet_or_empty

# Touched partitions that one merge reads and writes at most; a source that touches more is merged slice by slice.
LISTED_PARTITIONS = 1000
# Up to this many touched partitions, tasks write straight from the join. A parameter of file layout only.
DIRECT_PARTITIONS = 4
# Source keys are broadcast up to this measured size.
BROADCAST_BYTES = 32 * 1024 * 1024

_FRESH = "_fresh"
# How a folder writes a null.
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
# The key column that partitions follow from.
EVENT_TIME = "event_time"


class Upserted(NamedTuple):
    """Rows taken from the source (after dedupe), and target rows carried over unchanged."""

    from_source: int
    carried_over: int


def create_target(spark: SparkSession, path: str, schema: StructType = TARGET_SCHEMA) -> None:
    """Create the empty table if nothing is there yet."""
    no_rows(spark, schema).write.mode("ignore").partitionBy(*PARTITION_COLS).parquet(path)


def read_target(spark: SparkSession, path: str, schema: StructType = TARGET_SCHEMA) -> DataFrame:
    return read_parquet_or_empty(spark, path, schema)


def _read_days(spark: SparkSession, path: str, schema: StructType, days: Sequence[str]) -> DataFrame:
    """Rows of some partitions. Only their folders are listed, however many the table has."""
    folder = spark._jvm.org.apache.hadoop.fs.Path
    fs = folder(path).getFileSystem(spark._jsc.hadoopConfiguration())
    names = [[_NO_VALUE if part == "None" else part for part in day.split("/")] for day in days]
    places = ["/".join([path, *[f"{c}={v}" for c, v in zip(PARTITION_COLS, values)]]) for values in names]
    there = [p for p in places if fs.exists(folder(p))]
    if not there:
        return no_rows(spark, schema)
    reader = spark.read.schema(schema).options(basePath=path, pathGlobFilter="*.parquet")
    return reader.parquet(*there).select(*schema.names)


def stage(source: DataFrame, path: str, schema: StructType = TARGET_SCHEMA) -> DataFrame:
    """Materialise the source in the target's columns at ``path``, replacing what was there.

    Upsert reads its source more than once; staging spares repeated parsing or fetching, and
    fixes values that would differ between reads.
    """
    conform(source, schema, unfit="raise").write.mode("overwrite").parquet(path)
    return source.sparkSession.read.schema(schema).parquet(path)


def upsert(
    source: DataFrame,
    path: str,
    keys: Sequence[str] = KEY_COLS,
    latest_by: Sequence[str] = ("timestamp",),
    schema: StructType = TARGET_SCHEMA,
    journal: str | None = None,
    on_unkeyed: Callable[[DataFrame], None] | None = None,
    keep_newer: bool = False,
    slice_days: int | None = None,
) -> Upserted:
    """Merge ``source`` into the table at ``path``: replace rows with an equal key, add the rest.

    A replaced row takes every non-key column from the source, nulls included. Of several source
    rows with one key the latest wins. The source replaces whatever the table holds, as MERGE does; with
    ``keep_newer`` a row of the table stays that is later by ``latest_by``, so that loads may come in any order.
    Running the same upsert twice is the same as running it once, but for rows with a null in the key: it
    equals nothing, so they are added each time. With ``on_unkeyed`` such rows, if there are any, are handed to
    it and not merged. A value that does not fit its column fails the upsert. A source that touches more than ``slice_days``
    partitions is merged in slices of so many. ``keys`` must hold ``event_time``, or a key could lie in several partitions.

    One writer per table: plain Parquet has no transactions. Losing executors is harmless, but a
    driver lost while it swaps partition folders could leave one without its old rows. With a
    ``journal`` folder the merged partitions are kept there until the swap is over, and the
    next upsert finishes an interrupted one first; pass the same folder every time.
    """
    if EVENT_TIME not in keys:
        raise ValueError(f"{EVENT_TIME} must be part of the key: it gives the partition")
    spark = source.sparkSession
    if journal is not None:
        finish_interrupted(spark, journal, schema)
    create_target(spark, path, schema)
    incoming = add_date_parts(conform(source, schema, keys, "raise")).select(*schema.names)

    if on_unkeyed is not None:
        incoming, unkeyed = split_on_null(incoming, keys)
        if not unkeyed.isEmpty():
            on_unkeyed(unkeyed)
    done, by_day = Upserted(0, 0), None
    for touch in _touched_slices(incoming, keys, slice_days or LISTED_PARTITIONS):
        if not touch.whole and by_day is None:
            by_day = _written_by_day(incoming, schema)
        # A slice's own folders; one slice has all rows.
        part = incoming if touch.whole else by_day.where(_folder(by_day).isin(touch.days))
        counts = Observation()
        merged = merge(part, _read_days(spark, path, schema, touch.days), keys, latest_by, touch, keep_newer).observe(
            counts, F.count_if(_FRESH).alias("from_source"), F.count_if(~F.col(_FRESH)).alias("carried_over")
        ).drop(_FRESH)

        if journal is None:
            _swap_partitions(merged, path)
        else:
            # Static even where the cluster's default is not: nothing of an earlier run may stay.
            pending = merged.write.mode("overwrite").option("partitionOverwriteMode", "static")
            pending.partitionBy(*PARTITION_COLS).parquet(_pending(journal))
            _note(spark, journal, path)
            finish_interrupted(spark, journal, schema)
        done = Upserted(done.from_source + counts.get["from_source"], done.carried_over + counts.get["carried_over"])
    return done


def _written_by_day(incoming: DataFrame, schema: StructType) -> DataFrame:
    """The source as a table by partition, so that slices open their own folders instead of reading all of it."""
    path = scratch_path(incoming.sparkSession, "upsert-by-day")
    incoming.hint("rebalance", *PARTITION_COLS).write.partitionBy(*PARTITION_COLS).parquet(path)
    return incoming.sparkSession.read.schema(schema).parquet(path).select(*schema.names)


class Touch(NamedTuple):
    """Partitions that a source, or a slice of it, touches."""

    days: list[str]  # as year/month/day
    key_bytes: int
    whole: bool


def _touched_slices(incoming: DataFrame, keys: Sequence[str], limit: int) -> Iterator[Touch]:
    """Measure the source in one pass over its keys, kept as a row per partition; the driver holds one slice of partitions at a time."""
    key_bytes = F.lit(32)
    for k in keys:
        key_bytes = key_bytes + F.coalesce(F.octet_length(F.col(k).cast("string")), F.lit(0))
    day = _folder(incoming).alias("day")
    per_day = checkpointed(incoming.groupBy(day).agg(F.sum(key_bytes).alias("key_bytes")))
    last: str | None = None
    while True:
        beyond = per_day if last is None else per_day.where(F.col("day") > last)
        listed = beyond.orderBy("day").limit(limit + 1).collect()
        some, more = listed[:limit], len(listed) > limit
        if some:
            whole = last is None and not more
            yield Touch([r.day for r in some], sum(r.key_bytes for r in some), whole)
        if not more:
            return
        last = some[-1].day


def merge(
    incoming: DataFrame, target: DataFrame, keys: Sequence[str], latest_by: Sequence[str], touch: Touch, keep_newer: bool = False
) -> DataFrame:
    """New contents of the partitions that ``incoming`` touches, with a flag ``_fresh``."""
    fresh = dedupe_latest(incoming, keys, latest_by)
    current = target.where(_folder(target).isin(touch.days))
    # New days need no join; one look at their (absent) files tells.
    if current.isEmpty():
        merged = fresh.withColumn(_FRESH, F.lit(True))
    elif keep_newer and touch.key_bytes <= BROADCAST_BYTES:
        # Only rows that the source has a key of are compared; the others stay where the scan has them.
        merged = _latest_of_both(fresh, _matched(current, incoming, keys), keys, latest_by).unionByName(
            _unmatched(current, incoming, keys, touch)
        )
    elif keep_newer:
        merged = _latest_of_both(fresh, current, keys, latest_by)
    else:
        merged = fresh.withColumn(_FRESH, F.lit(True)).unionByName(_unmatched(current, incoming, keys, touch))
    # Tasks of the join hold rows of every day. With few days, writing from there makes a file
    # per task and day of a good size; with many, rows are first brought together by day.
    return merged if len(touch.days) <= DIRECT_PARTITIONS else merged.hint("rebalance", *PARTITION_COLS)


def _latest_of_both(fresh: DataFrame, current: DataFrame, keys: Sequence[str], latest_by: Sequence[str]) -> DataFrame:
    """Per key the later of the source's and the table's row; rows without a key all stay.

    Ties go to the greatest remaining columns as within a source, so the outcome depends on no order of loads.
    """
    both = fresh.withColumn(_FRESH, F.lit(True)).unionByName(current.withColumn(_FRESH, F.lit(False)))
    return dedupe_latest(both, keys, latest_by)


def _matched(current: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key the source has; its keys have been measured to be small."""
    known = F.broadcast(incoming.select(*keys).distinct())
    return current.join(known, fixed_width_first(current, keys), "left_semi").select(*current.columns)


def _unmatched(current: DataFrame, incoming: DataFrame, keys: Sequence[str], touch: Touch) -> DataFrame:
    """Target rows whose key the source does not have.

    Distinct keys are combined before the shuffle, so a key repeated in the source costs one row
    per map task. When they are measured to be small, the target is not shuffled at all.
    """
    matched = incoming.select(*keys).distinct()
    order = fixed_width_first(current, keys)
    if touch.key_bytes <= BROADCAST_BYTES:
        kept = current.join(F.broadcast(matched), order, "left_anti")
    else:
        # A null equals nothing, so rows with one in the key stay and need not meet in one task.
        keyed, unkeyed = split_on_null(current, keys)
        kept = keyed.join(matched, order, "left_anti").select(*current.columns).unionByName(unkeyed)
    return kept.select(*current.columns).withColumn(_FRESH, F.lit(False))


def finish_interrupted(spark: SparkSession, journal: str, schema: StructType = TARGET_SCHEMA) -> None:
    """Bring partitions noted in the journal into their table; repeating it changes nothing."""
    no_rows(spark, _LOG_SCHEMA).write.mode("ignore").parquet(_log(journal))
    noted = spark.read.schema(_LOG_SCHEMA).parquet(_log(journal)).first()
    if noted is not None:
        _swap_partitions(read_target(spark, _pending(journal), schema), noted.target)
        _note(spark, journal, None)


def _swap_partitions(rows: DataFrame, path: str) -> None:
    """Replace the partitions that occur in ``rows``."""
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*PARTITION_COLS).parquet(path)


_LOG_SCHEMA = StructType().add("target", "string")


def _pending(journal: str) -> str:
    return f"{journal}/pending"


def _log(journal: str) -> str:
    return f"{journal}/log"


def _note(spark: SparkSession, journal: str, target: str | None) -> None:
    """Record for which table (if any) complete partitions are pending."""
    log = no_rows(spark, _LOG_SCHEMA) if target is None else spark.range(1).select(F.lit(target).alias("target"))
    log.coalesce(1).write.mode("overwrite").parquet(_log(journal))


def _folder(df: DataFrame) -> Column:
    """A partition as text, with nulls spelled out; prunes folders when compared to literals."""
    return F.concat_ws("/", *[F.coalesce(df[c].cast("string"), F.lit("None")) for c in PARTITION_COLS])
