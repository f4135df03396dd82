"""Counts of every micro-batch, kept as a table."""

from __future__ import annotations

import logging
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.types import StructType

from roadlake.sources.processed import read_parquet_or_empty

log = logging.getLogger(__name__)

SCHEMA = (
    StructType().add("job", "string").add("query_id", "string").add("batch", "long").add("at", "timestamp")
    .add("rows_in", "long").add("rows", "long").add("left_out", "long").add("duration_ms", "long")
)


class _Listener(StreamingQueryListener):
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def onQueryStarted(self, event) -> None:
        log.info("%s started, run %s", event.name, event.runId)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        counts = (p.observedMetrics or {}).get("counts")
        if not p.numInputRows:
            return
        values = {
            "job": p.name, "query_id": str(p.id), "batch": p.batchId, "at": p.timestamp, "rows_in": p.numInputRows,
            "rows": counts and counts["rows"], "left_out": counts and counts["left_out"], "duration_ms": p.batchDuration,
        }
        row = self.spark.range(1).select(*[F.lit(values[f.name]).cast(f.dataType).alias(f.name) for f in SCHEMA.fields])
        row.coalesce(1).write.mode("append").parquet(self.path)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            log.error("run %s failed: %s", event.runId, event.exception)


@contextmanager
def audited(spark: SparkSession, path: str) -> Iterator[None]:
    """Note what every micro-batch of the session's queries reads, keeps and leaves out, one row each, at ``path``.

    Leaving the block waits until the batches that are over have been noted. A driver that is lost takes at most the row
    of its last batch with it.
    """
    listener = _Listener(spark, path)
    spark.streams.addListener(listener)
    try:
        yield
    finally:
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        spark.streams.removeListener(listener)


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    """One row per query and micro-batch; of a batch that was repeated the last run counts."""
    rows = read_parquet_or_empty(spark, path, SCHEMA)
    last = rows.groupBy("query_id", "batch").agg(F.max(F.struct("at", *[c for c in SCHEMA.names if c not in ("query_id", "batch", "at")])).alias("x"))
    return last.select("query_id", "batch", "x.*").select(*SCHEMA.names)
