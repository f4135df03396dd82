"""Loads that cost what they change.

The table has two partition levels: the day of an event and, below it, a bucket that follows from the key, so a load of few keys
opens few folders. Every row carries a digest of its values. A load reads keys and digests of the folders it
touches, says of each of its rows whether it is inserted, updated or changes nothing, keeps the first two as a change feed, and
rewrites only the folders that have some. Folders that the table has are first compared by keys, times and digests alone; whole rows
are read of those with a change and of new ones. They cross one exchange, by folder: it finds the latest row of a key,
compares it with the table and leaves rows where they are written. Rows of rewritten folders that stay are carried over from the scan
by a broadcast of the changed keys. Folders that the table does not have yet are taken from the feed as they lie there.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from roadlake.functions.event_time import add_date_parts
from roadlake.operators.columns import conform
from roadlake.operators.dedupe import dedupe_keyed, fixed_width_first, recency, split_on_null
from roadlake.operators.upsert import BROADCAST_BYTES, EVENT_TIME
from roadlake.schema import KEY_COLS, PARTITION_COLS, TARGET_SCHEMA
from roadlake.session import no_rows
from roadlake.sources.processed import read_parquet_or_empty

BUCKET, DIGEST, CHANGE, ATTEMPT = "bucket", "row_digest", "change", "attempt"
_CUT = "_cut"
INSERTED, UPDATED, UNCHANGED, STALE = "inserted", "updated", "unchanged", "stale"
KINDS = (INSERTED, UPDATED, UNCHANGED, STALE)
FOLDER_COLS = [*PARTITION_COLS, BUCKET]
#: Buckets of a day. A table keeps the number it was made with.
BUCKETS = 16
#: Folders that one step of a load rewrites at most.
LISTED_FOLDERS = 1000
#: Source rows of a folder beyond which several tasks take it, each some of its keys.
CUT_ROWS = 200_000
#: Source rows of a folder beyond one per key from which on rows are reduced to one per key before they are sent.
REPEATED_ROWS = 1_000_000
#: Columns that say when a row was written and not what it holds.
AUDIT_COLS = ("last_updated",)


class Changed(NamedTuple):
    """Rows of a source (one per key) by what they did, and folders written anew."""

    inserted: int
    updated: int
    unchanged: int
    stale: int
    folders: int


def table_schema(schema: StructType = TARGET_SCHEMA) -> StructType:
    """A table's columns: those of ``schema``, the digest, and the bucket that its folders have."""
    return StructType([*schema.fields]).add(DIGEST, "binary").add(BUCKET, "integer")


def read_keyed(spark: SparkSession, path: str, schema: StructType = TARGET_SCHEMA) -> DataFrame:
    """The table's rows, without digest and bucket."""
    return read_parquet_or_empty(spark, path, table_schema(schema)).select(*schema.names)


def read_feed(spark: SparkSession, feed: str, keys: Sequence[str] = KEY_COLS, schema: StructType = TARGET_SCHEMA) -> DataFrame:
    """What loads have inserted and updated: ``run``, ``change`` and the new row, one per run and key."""
    columns = [*schema.names, CHANGE, "run"]
    noted = read_parquet_or_empty(spark, feed, StructType([*schema.fields]).add(CHANGE, "string").add("run", "string").add(ATTEMPT, "string"))
    # An attempt has a key once; a load that was cut off and repeated may have noted a row twice. Other rows are not shuffled.
    repeated = noted.groupBy("run").agg((F.count_if(F.col(ATTEMPT).isNull()) > 0).alias("old"), F.min(ATTEMPT).alias("low"), F.max(ATTEMPT).alias("high"))
    repeated = F.broadcast(repeated.where("old OR low < high").select("run"))
    again = noted.join(repeated, "run", "left_semi").select(*columns).dropDuplicates(["run", *keys])
    return noted.join(repeated, "run", "left_anti").select(*columns).unionByName(again)


def apply_changes(
    source: DataFrame,
    path: str,
    feed: str,
    run: str,
    keys: Sequence[str] = KEY_COLS,
    latest_by: Sequence[str] = ("timestamp",),
    schema: StructType = TARGET_SCHEMA,
    buckets: int = BUCKETS,
    keep_newer: bool = False,
    on_unkeyed: Callable[[DataFrame], None] | None = None,
    listed: int | None = None,
) -> Changed:
    """Merge ``source`` into the keyed table at ``path`` and note what changed below ``feed``/run=``run``.

    Of several source rows with one key the latest wins, ties go to the greater digest. A row with the values of the table's row
    changes nothing, whenever it was written; another replaces it. With ``keep_newer`` the table's row stays if it is later by
    ``latest_by``, so loads may come in any order, and the source's row is ``stale``; a row with the time of the table's row is a correction
    and replaces it. Running a load twice is the same as running it
    once: the second run writes no folder. A load that was cut off is repeated with the same ``run``; what it has noted stays.

    Rows with a null in the key are handed to ``on_unkeyed``; without it they are refused. One writer per table; a
    driver lost while Spark moves finished files can leave a folder half replaced, as with any plain overwrite. A value that does not fit
    its column fails the load. The source is read more than once, first for the folders it touches, then for those that change; a load
    fails before it rewrites anything when the source has other folders the next time, or rows with other outcomes.
    """
    if EVENT_TIME not in keys:
        raise ValueError(f"{EVENT_TIME} must be part of the key: it gives the partition")
    spark = source.sparkSession
    whole = table_schema(schema)
    no_rows(spark, whole).write.mode("ignore").partitionBy(*FOLDER_COLS).parquet(path)
    incoming, unkeyed = split_on_null(add_date_parts(conform(source, schema, keys, "raise")).select(*schema.names), keys)
    if not unkeyed.isEmpty():
        if on_unkeyed is None:
            raise ValueError(f"rows with a null in {', '.join(keys)}")
        on_unkeyed(unkeyed)
    # Each attempt notes its rows apart, so that rows which a lost one has noted are not taken for its own.
    run_feed = f"{feed}/run={run}/{ATTEMPT}={uuid.uuid4().hex}"
    rows = _with_folder(incoming, keys, buckets).select(*whole.names)
    touched = _measure(rows, keys)
    current = _of(_table(spark, path, whole), touched)
    held = {r.folder for r in current.select(_folder().alias("folder")).distinct().collect()}
    if _repeats(touched):
        rows = dedupe_keyed(rows, keys, [*latest_by, DIGEST])
    cut = _cut(touched, keys).alias(_CUT)
    outcomes = _outcomes(rows.select("*", cut), current.select("*", cut), keys, latest_by, keep_newer, [*FOLDER_COLS, _CUT]).drop(_CUT)
    _by_folder(no_rows(spark, whole).withColumn(CHANGE, F.lit("")), "overwrite", "static").parquet(run_feed)
    kinds = _recount(_of(rows, held), current, keys, latest_by, keep_newer, buckets) if held else {}
    idle = {f for f, found in kinds.items() if not found[INSERTED] + found[UPDATED]}
    done = Counter(_sum(kinds[f] for f in idle))
    if idle.issuperset(touched):
        return Changed(*[done[k] for k in KINDS], 0)
    observed = _note(outcomes.where(~_folder().isin(list(idle))) if idle else outcomes, run_feed)
    noted = spark.read.schema(StructType([*whole.fields]).add(CHANGE, "string")).parquet(run_feed)
    sizes = _changed_folders(noted, keys)
    # A write of no rows is cut short and reports nothing. Rows of new folders are all inserted.
    found, expected = Counter(observed.get if sizes else {}), _sum(kinds[f] for f in kinds.keys() - idle)
    if not touched.keys() >= sizes.keys() or any(found[k] != expected[k] for k in KINDS if k != INSERTED):
        raise RuntimeError("the source has other rows than when its folders were listed")
    for folders in _steps({f: n for f, n in sizes.items() if f in held}, listed or LISTED_FOLDERS):
        _rewrite(_of(noted, folders), _of(_table(spark, path, whole), folders), keys, path)
    for folders in _steps({f: 0 for f in sizes if f not in held}, listed or LISTED_FOLDERS):
        _add(_of(noted, folders), path)
    return Changed(*[done[k] + found[k] for k in KINDS], len(sizes))


def _with_folder(rows: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    values = [c for c in rows.columns if c not in AUDIT_COLS]
    text = F.to_json(F.struct(*values), {"ignoreNullFields": "false"})
    return rows.withColumns({
        DIGEST: F.unhex(F.md5(text)), BUCKET: _bucket(keys, buckets),
    })


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*sorted(keys)), F.lit(buckets)).cast("int")


class _Size(NamedTuple):
    """Source rows of a folder, and about how many keys they have."""

    rows: int
    keys: int


def _measure(rows: DataFrame, keys: Sequence[str]) -> dict[str, _Size]:
    """Folders that the source touches."""
    found = rows.groupBy(_folder().alias("folder")).agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct(F.xxhash64(*keys)).alias("n_keys"))
    return {r.folder: _Size(r.n, r.n_keys) for r in found.collect()}


def _repeats(touched: Mapping[str, _Size]) -> bool:
    """Whether keys come so often that one could be too much for a task; a quarter more rows than keys may be the estimate's error."""
    return any(size.rows - size.keys > max(REPEATED_ROWS, size.rows // 4) for size in touched.values())


def _cut(touched: Mapping[str, _Size], keys: Sequence[str]) -> Column:
    """Which part of a large folder a key belongs to; folders have a power of two of parts, most of them one."""
    parts: dict[int, list[str]] = {}
    for folder, size in touched.items():
        if size.rows > CUT_ROWS:
            parts.setdefault(1 << ((size.rows - 1) // CUT_ROWS).bit_length(), []).append(folder)
    number = F.lit(1)
    for n, folders in parts.items():
        number = F.when(_folder().isin(folders), n).otherwise(number)
    return F.pmod(F.hash(*sorted(keys)), number)


def _sum(counts: Iterable[Mapping[str, int]]) -> Counter[str]:
    return sum((Counter(c) for c in counts), Counter())


def _by_folder(rows: DataFrame, mode: str, overwrite: str, together: bool = False):
    """Rows brought together by folder, if they are not yet; a large folder is cut into several tasks."""
    writer = (rows if together else rows.hint("rebalance", *FOLDER_COLS)).write.mode(mode)
    return writer.option("partitionOverwriteMode", overwrite).partitionBy(*FOLDER_COLS)


def _table(spark: SparkSession, path: str, whole: StructType) -> DataFrame:
    return spark.read.schema(whole).parquet(path)


def _folder() -> Column:
    return F.concat_ws("/", *FOLDER_COLS)


def _of(rows: DataFrame, folders: Iterable[str]) -> DataFrame:
    """Rows of the listed folders; literal names, so others are not opened."""
    return rows.where(_folder().isin(list(folders)))


def _changed_folders(noted: DataFrame, keys: Sequence[str]) -> dict[str, int]:
    """Folders that have changes, and the bytes of the keys updated in each."""
    size = F.lit(32)
    for k in keys:
        size = size + F.octet_length(F.col(k).cast("string"))
    updated = F.coalesce(F.sum(F.when(F.col(CHANGE) == UPDATED, size)), F.lit(0))
    return {r.folder: r.size for r in noted.groupBy(_folder().alias("folder")).agg(updated.alias("size")).collect()}


def _steps(sizes: Mapping[str, int], limit: int) -> Iterator[list[str]]:
    """Folders in order, a bounded number at a time, and so few that the updated keys of a step can be broadcast.

    A folder with more updated keys than that is a step of its own.
    """
    step: list[str] = []
    held = 0
    for folder in sorted(sizes):
        if step and (len(step) == limit or held + sizes[folder] > BROADCAST_BYTES):
            yield step
            step, held = [], 0
        step.append(folder)
        held += sizes[folder]
    if step:
        yield step


def _recount(
    rows: DataFrame, current: DataFrame, keys: Sequence[str], latest_by: Sequence[str], keep_newer: bool, buckets: int
) -> dict[str, Counter[str]]:
    """Outcomes by folder and kind from keys, times and digests alone: rows of a key with the same digest have the same outcome."""
    narrow = rows.select(*dict.fromkeys([*keys, *latest_by, DIGEST]))
    found = _outcomes(narrow, current, keys, latest_by, keep_newer)
    found = add_date_parts(found).withColumn(BUCKET, _bucket(keys, buckets))
    kinds: dict[str, Counter[str]] = {}
    for r in found.groupBy(_folder().alias("folder"), CHANGE).agg(F.count(F.lit(1)).alias("n")).collect():
        kinds.setdefault(r.folder, Counter())[r[CHANGE]] = r.n
    return kinds


def _outcomes(
    rows: DataFrame, current: DataFrame, keys: Sequence[str], latest_by: Sequence[str], keep_newer: bool, by: Sequence[str] = ()
) -> DataFrame:
    """The latest row of each key with ``change``, from keys and digests of the table alone.

    ``by`` are columns of both that follow from the key; rows are exchanged by those, or else by the key. Source and table
    meet in one aggregate, so that columns other than the key can decide where.
    """
    placed = [*by, *fixed_width_first(rows, keys)]
    order = [c for c in latest_by if c not in keys]
    rest = [c for c in rows.columns if c not in (*placed, DIGEST)]

    def ranked(df: DataFrame) -> list[Column]:
        return [*[recency(df, c).alias(f"_by{i}") for i, c in enumerate(order)], F.col(DIGEST).alias("_digest")]

    offered = rows.select(*placed, F.struct(*ranked(rows), *rest).alias("_row"))
    held = current.select(*placed, F.struct(*ranked(current)).alias("_held"))
    # Exchanged before they are aggregated, so that no task sorts its whole share of the source.
    both = offered.unionByName(held, allowMissingColumns=True).repartition(*(by or placed))
    met = both.groupBy(*placed).agg(F.max("_row").alias("_row"), F.max("_held").alias("_held")).where("_row IS NOT NULL")

    row, there = F.col("_row"), F.col("_held")
    change = F.when(there.isNull(), INSERTED).when(there["_digest"] == row["_digest"], UNCHANGED)
    if keep_newer:
        times = [F.struct(*[of[f"_by{i}"].alias(f"_by{i}") for i in range(len(order))]) for of in (row, there)]
        change = change.when(times[0] < times[1], STALE)
    columns = [row["_digest"].alias(c) if c == DIGEST else F.col(c) if c in placed else row[c].alias(c) for c in rows.columns]
    return met.select(*columns, change.otherwise(UPDATED).alias(CHANGE))


def _note(outcomes: DataFrame, run_feed: str) -> Observation:
    """Append inserted and updated rows, which lie by folder, to the run's feed; counts of all kinds come from the same pass."""
    counts = Observation()
    counted = outcomes.observe(counts, *[F.count_if(F.col(CHANGE) == k).alias(k) for k in KINDS])
    _by_folder(counted.where(F.col(CHANGE).isin(INSERTED, UPDATED)), "append", "static", True).parquet(run_feed)
    return counts


def _rewrite(noted: DataFrame, current: DataFrame, keys: Sequence[str], path: str) -> None:
    """Replace the folders that ``noted`` has rows of."""
    updated = noted.where(F.col(CHANGE) == UPDATED).select(*fixed_width_first(noted, keys))
    size = F.lit(32)
    for k in keys:
        size = size + F.octet_length(F.col(k).cast("string"))
    measured = updated.agg(F.sum(size)).first()[0]
    small = measured is None or measured <= BROADCAST_BYTES
    kept = current.join(F.broadcast(updated) if small else updated, list(updated.columns), "left_anti").select(*current.columns)
    _by_folder(kept.unionByName(noted.drop(CHANGE)), "overwrite", "dynamic").parquet(path)


def _add(noted: DataFrame, path: str) -> None:
    """Write folders that the table does not have; the feed's files are by folder already."""
    writer = noted.drop(CHANGE).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*FOLDER_COLS).parquet(path)
