"""Count-or-time batches over a bounded frame, on a fixed lattice of time; ``closing`` has batches closed one after the other."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from roadlake.operators.numbering import numbered

# The size and the age at which a batch is closed.
MAX_ROWS = 100
MAX_SECONDS = 60


def assign_batches(
    df: DataFrame,
    time_col: str,
    tie_breakers: Sequence[str] = (),
    max_rows: int = MAX_ROWS,
    max_seconds: int = MAX_SECONDS,
) -> DataFrame:
    """Add ``bucket_start`` and ``batch_no`` (from 0 within the bucket).

    A batch spans at most ``max_seconds`` and holds at most ``max_rows`` rows, in order of
    ``time_col`` then ``tie_breakers``; rows equal in both come in any order. Buckets lie on
    fixed multiples of ``max_seconds``, so they can be numbered independently.

    Rows are numbered over all tasks, so a bucket may be of any size.
    """
    second = F.unix_seconds(F.col(time_col).cast("timestamp"))
    bucketed = df.withColumn("bucket_start", F.timestamp_seconds(second - F.pmod(second, F.lit(max_seconds))))
    rows = numbered(bucketed, ["bucket_start"], [time_col, *tie_breakers], "_position")
    batch_no = F.floor(F.col("_position") / F.lit(max_rows)).cast("bigint")
    return rows.select(*bucketed.columns, batch_no.alias("batch_no"))


def batch_counts(batched: DataFrame) -> DataFrame:
    """Rows per batch."""
    return batched.groupBy("bucket_start", "batch_no").agg(F.count(F.lit(1)).alias("n_rows"))
