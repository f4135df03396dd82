"""How filters of a corpus overlap, whatever the order in which they are applied.

The documents' files are read as a stream of available-now micro-batches. Every document has a mask: one bit per filter
that it fails. The filters on a text alone are expressions; whether a smaller id has the same text is known only
once all files have been seen, so the stream keeps a state of every text, addressed by its SHA-256: the least id so
far and where its documents are counted. A batch with a smaller id retracts the earlier mask from the counters of its
part and adds the one with the duplicate bit. What leaves a micro-batch is the change of the counters; all orders of
the filters are read off their sum, which has a row per part, mask and label at most.

Texts are keyed in buckets of about ``TEXTS`` by their hash, so that a call of the state function serves many.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping
from itertools import permutations

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

from roadlake.session import no_rows, scratch_path

#: Micro-batches that a run over a table is cut into, as far as it has files.
BATCHES = 4
#: Texts that share a key of the state, as far as their number is known when a state is begun.
TEXTS = 1024
#: Expression of a text that is true where the text fails.
Check = Callable[[Column], Column]

_ROW = "bucket long, key binary, id long, late boolean, part string, mask int, good int, toxic int, n long"
#: Bucket of the rows without an id.
ALONE = -1
_CHANGE = "part string, mask int, good int, toxic int, n long"
_SETTINGS = {"spark.sql.streaming.checkpoint.fileChecksum.enabled": "false"}
_LOCAL_SETTINGS = {
    "spark.sql.streaming.checkpointFileManagerClass": "org.apache.spark.sql.execution.streaming.checkpointing.FileSystemBasedCheckpointFileManager"
}
#: Rows of the bucket's least ids, as an Arrow table.
_STATE = "rows binary"
_KEPT = ["key", "id", "part", "mask", "good", "toxic"]
_COUNTED = ["part", "mask", "good", "toxic"]


def words(text: Column) -> Column:
    """Maximal runs of characters other than ASCII white space."""
    return F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")


def _few_words(text: Column) -> Column:
    return F.size(words(text)) < 100


def _repeated_words(text: Column) -> Column:
    return 100 * F.size(F.array_distinct(words(text))) < 80 * F.size(words(text))


def _capitals(text: Column) -> Column:
    return 100 * F.regexp_count(text, F.lit("[A-Z]")) > 10 * F.length(text)


def _symbols(text: Column) -> Column:
    return text.rlike("[#$%&*|]")


#: Filters on a text alone, and the name of the one on texts of smaller ids.
CHECKS: dict[str, Check] = {"A": _few_words, "B": _repeated_words, "C": _capitals, "D": _symbols}
DUPLICATE = "E"


def audit(
    spark: SparkSession,
    path: str,
    labels: DataFrame,
    checks: Mapping[str, Check] = CHECKS,
    duplicate: str = DUPLICATE,
    batches: int = BATCHES,
    state: str | None = None,
) -> DataFrame:
    """Counts of every part, order of the filters and step, for the Parquet documents at ``path``.

    Columns ``part`` (``lang``; null: empty), ``filter_order``, ``step`` (from 1), ``kept``, ``removed``, ``redundant``,
    ``unique_fails``, ``good_lost``, ``toxic_lost`` and ``shapley``, as :func:`orders` describes them. Filters have one letter each.

    ``state`` is a folder that outlives the call: another call with it takes the files that have come since. Without
    one a new one is made. ``labels`` has ``doc_id``, ``quality`` and ``toxic``; of several labels of an id
    any 1 counts. Null texts are empty. Documents with one id and one text do not fail for each other, each counts;
    a null id is smaller than none, and none is smaller than it. No documents give no rows.
    """
    state = state or scratch_path(spark, "filter-audit")
    return orders(counters(spark, path, labels, state, checks, duplicate, batches), [*checks, duplicate])


def counters(
    spark: SparkSession, path: str, labels: DataFrame, state: str, checks: Mapping[str, Check], duplicate: str, batches: int
) -> DataFrame:
    """Documents per part, mask (bit i for filter i, the duplicate's last) and label, after all files at ``path``."""
    changes, bit = f"{state}/changes", 1 << len(checks)
    schema = StructType.fromDDL(_CHANGE)
    no_rows(spark, schema).write.mode("overwrite").parquet(f"{changes}/batch=-1")
    whole = spark.read.parquet(path)
    # Written once: a text must stay in its bucket.
    spark.range(1).select(F.lit(whole.count() // TEXTS + 1).alias("buckets")).write.mode("ignore").parquet(f"{state}/layout")
    buckets = spark.read.schema("buckets int").parquet(f"{state}/layout").first().buckets
    per_batch = -(-max(1, len(whole.inputFiles())) // batches)
    files = spark.readStream.schema(whole.select("doc_id", "text", "lang").schema).options(
        maxFilesPerTrigger=str(per_batch), maxFileAge="36500d"
    )
    masked = _with_labels(_masked(files.parquet(_watched(whole, path)), checks, buckets), labels)
    # A text repeated in any share of the rows sends a row or two per Arrow batch to the task that keeps its state.
    combined = masked.mapInPandas(_combined, _ROW)
    changed = combined.groupBy("bucket").applyInPandasWithState(
        lambda key, frames, kept: _retracted(key, frames, kept, bit), _CHANGE, _STATE, "append", GroupStateTimeout.NoTimeout
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        # A repeated micro-batch replaces what it has written before.
        summed = batch.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))
        summed.write.mode("overwrite").parquet(f"{changes}/batch={batch_id}")

    writer = changed.writeStream.foreachBatch(write).option("checkpointLocation", f"{state}/checkpoint")
    _started(spark, writer.trigger(availableNow=True), state).awaitTermination()
    rows = spark.read.schema(schema).parquet(changes)
    total = rows.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))
    return total.where("n > 0")


def _started(spark: SparkSession, writer: DataStreamWriter, state: str) -> StreamingQuery:
    """The query, started with settings that spare every partition of the state a pool of threads for checksums, and on a local file
    system a process for each file that is looked at."""
    path = spark._jvm.org.apache.hadoop.fs.Path(state)
    local = path.getFileSystem(spark._jsc.hadoopConfiguration()).getScheme() == "file"
    wanted = _SETTINGS | (_LOCAL_SETTINGS if local else {})
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        return writer.start()  # it goes on with a copy of the session
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _watched(whole: DataFrame, path: str) -> str:
    """``path`` as a stream takes it: a folder as it is, a single file as a pattern that it alone matches."""
    is_file = [f.rsplit("/", 1)[-1] for f in whole.inputFiles()] == [path.rsplit("/", 1)[-1]]
    return f"{path[:-1]}[{path[-1]}]" if is_file else path


def _masked(docs: DataFrame, checks: Mapping[str, Check], buckets: int) -> DataFrame:
    text = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    mask = F.lit(0)
    for i, fails in enumerate(checks.values()):
        mask = mask + F.when(fails(F.col("text")), 1 << i).otherwise(0)
    # A null id takes no part in duplicates: it has a bucket without a state.
    digest = F.when(F.col("doc_id").isNotNull(), F.sha2("text", 256))
    hashed = text.select(F.col("doc_id").cast("long").alias("id"), "part", mask.alias("mask"), digest.alias("digest"))
    bucket = F.conv(F.substring("digest", 1, 12), 16, 10).cast("long") % buckets
    return hashed.select(
        "id", "part", "mask", F.coalesce(bucket, F.lit(ALONE)).alias("bucket"), F.coalesce(F.unhex("digest"), F.lit(b"")).alias("key")
    )


def _with_labels(docs: DataFrame, labels: DataFrame) -> DataFrame:
    is_one = lambda c: F.max(F.when(F.col(c) == 1, 1).otherwise(0))
    per_id = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("id")).agg(
        is_one("quality").alias("good"), is_one("toxic").alias("toxic")
    )
    none = F.lit(0)
    return docs.join(per_id, "id", "left").select(
        "bucket", "key", F.coalesce("id", none).alias("id"), "part", "mask", F.coalesce("good", none).alias("good"), F.coalesce("toxic", none).alias("toxic")
    )


def _combined(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Counts per text, part and label: of a text's least id in the batch, and of the later ids together."""
    for rows in frames:
        least = rows.groupby("key")["id"].transform("min")
        rows = rows.assign(id=least, late=rows["id"] > least)
        yield rows.groupby(["bucket", *_KEPT, "late"], sort=False).size().rename("n").reset_index()


def _retracted(key: tuple, frames: Iterable[pd.DataFrame], kept: GroupState, bit: int) -> Iterator[pd.DataFrame]:
    """Changes of the counters by a bucket's rows of a micro-batch; ``kept`` gets the rows of each text's least id."""
    rows = pd.concat(list(frames))
    if key[0] == ALONE:
        yield rows[[*_COUNTED, "n"]]
        return
    rows["old"] = False
    if kept.exists:
        old = pa.ipc.open_stream(kept.get[0]).read_pandas()
        rows = pd.concat([old.assign(old=True, late=False), rows])
    first = ~rows["late"].to_numpy(bool) & (rows["id"] == rows.groupby("key")["id"].transform("min")).to_numpy()
    was = rows["old"].to_numpy(bool)
    back, late = rows[was & ~first], rows[~first]
    changes = pd.concat([rows[first & ~was], late.assign(mask=late["mask"] + bit), back.assign(n=-back["n"])])
    held = rows[first].groupby(_KEPT, sort=False)["n"].sum().reset_index()
    kept.update((_stored(held),))
    yield changes.groupby(_COUNTED, sort=False)["n"].sum().reset_index()


def _stored(rows: pd.DataFrame) -> bytes:
    table, sink = pa.Table.from_pandas(rows, preserve_index=False), pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def orders(counted: DataFrame, filters: list[str]) -> DataFrame:
    """Every order of the filters and every step of it, from the counts of masks.

    Per part and step: ``kept`` after it and ``removed`` by it; ``redundant``, which fail its filter but were
    removed earlier; ``unique_fails``, which fail that filter alone; ``good_lost`` and ``toxic_lost``, those removed here that are labelled
    so; ``shapley``, what its filter removes in all orders together. A document that fails k filters is removed
    by each of them in one order of k.
    """
    masks = counted.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic")
    )
    steps, n_orders = [], 0
    for order in permutations(range(len(filters))):
        n_orders, before = n_orders + 1, 0
        for step, i in enumerate(order, 1):
            steps.append((before, 1 << i, "".join(filters[j] for j in order), step))
            before |= 1 << i
    # One row per mask and distinct (earlier filters, filter), then the orders that have it: the list is a fixed one.
    pairs = sorted({(before, bit) for before, bit, _, _ in steps})
    pair = lambda a, b: F.struct(F.lit(a).alias("before"), F.lit(b).alias("bit"))
    met = masks.select("*", F.explode(F.array(*[pair(*p) for p in pairs])).alias("at")).select("*", "at.*").drop("at")
    earlier, fails = F.col("mask").bitwiseAND(F.col("before")) != 0, F.col("mask").bitwiseAND(F.col("bit")) != 0
    count = lambda condition, of="n": F.coalesce(F.sum(F.when(condition, F.col(of))), F.lit(0)).alias
    removed = ~earlier & fails
    at_pair = met.groupBy("part", "before", "bit").agg(
        count(~earlier & ~fails)("kept"), count(removed)("removed"), count(earlier & fails)("redundant"),
        count(F.col("mask") == F.col("bit"))("unique_fails"), count(removed, "good")("good_lost"), count(removed, "toxic")("toxic_lost"),
        F.coalesce(F.sum(F.when(fails, F.expr(f"n * ({n_orders} div bit_count(mask))"))), F.lit(0)).alias("shapley"),
    )
    # Looked up in a literal, so that no join is needed.
    by_pair = F.create_map(*[
        x for p in pairs for x in (
            F.lit(p[0] * (1 << len(filters)) + p[1]),
            F.array(*[F.struct(F.lit(o).alias("filter_order"), F.lit(s).alias("step")) for a, b, o, s in steps if (a, b) == p]),
        )
    ])
    here = by_pair[F.col("before") * (1 << len(filters)) + F.col("bit")]
    return at_pair.select("*", F.explode(here).alias("o")).select(
        "part", "o.filter_order", "o.step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"
    )
