"""Partitioned file writes: bounded ones, and streams that write each row once."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, functions as F
from pyspark.sql.streaming.query import StreamingQuery

from roadlake.functions.event_time import add_date_parts, utc_date
from roadlake.schema import EVENT_COLS, PARTITION_COLS, PROCESSED_SCHEMA

LEFT_OUT = "left_out"
# Fixed value: rows per raw file.
ROWS_PER_RAW_FILE = 100


class Written(NamedTuple):
    """Rows written, and rows left out because they were flagged."""

    rows: int
    left_out: int


def write_files(
    df: DataFrame,
    path: str,
    file_format: str,
    partition_cols: list[str],
    gather_by: list[str] | None = None,
    options: Mapping[str, str] | None = None,
    mode: str = "append",
) -> Written:
    """Write the rows, but for those whose ``left_out`` column is true, to a partitioned tree.

    Rows are gathered by ``gather_by`` (the partition columns unless given) so that a folder gets
    few files; the rebalance hint lets AQE cut a folder that holds much of the data into several
    tasks. With an empty list every task writes the rows it has. ``append`` adds files;
    ``overwrite`` replaces the whole tree.

    Counts come from the write itself. Rows to leave out are few and cross the exchange with
    the others, so that one pass counts both kinds.
    """
    flag = F.coalesce(F.col(LEFT_OUT), F.lit(False)) if LEFT_OUT in df.columns else F.lit(False)
    df = df.withColumn(LEFT_OUT, flag)
    gather_by = partition_cols if gather_by is None else gather_by
    if gather_by:
        df = df.hint("rebalance", *gather_by)
    counts = Observation()
    counted = df.observe(counts, F.count_if(~F.col(LEFT_OUT)).alias("rows"), F.count_if(LEFT_OUT).alias("left_out"))
    rows = counted.where(~F.col(LEFT_OUT)).drop(LEFT_OUT)
    writer = rows.write.mode(mode).option("partitionOverwriteMode", "static").partitionBy(*partition_cols)
    writer.options(**(options or {})).format(file_format).save(path)
    return Written(**counts.get)


def start_sink(
    rows: DataFrame,
    path: str,
    file_format: str,
    checkpoint: str,
    pace: Mapping[str, object],
    partition_cols: Sequence[str],
    gather_by: Sequence[str] | None = None,
    options: Mapping[str, str] | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Append a stream to a tree of its own, each row once.

    Spark's file sink notes the files of a micro-batch in the tree's log when all are there, and passes over a batch that it
    has noted. Readers of ``path``, bounded or streaming, go by the log: what a lost run has left beside it is never
    read, whatever a rename is on the file system, and no tree is listed. The tree has this one query as writer. Rows are gathered as by
    :func:`write_files`.
    """
    gather_by = partition_cols if gather_by is None else gather_by
    if gather_by:
        rows = rows.hint("rebalance", *gather_by)
    writer = rows.writeStream.format(file_format).options(**(options or {})).partitionBy(*partition_cols)
    if name is not None:
        writer = writer.queryName(name)
    return writer.option("checkpointLocation", checkpoint).outputMode("append").trigger(**pace).start(path)


def dated_raw(df: DataFrame, arrived: str = "arrived") -> DataFrame:
    """Event columns with the (zero-padded) UTC date of the ``arrived`` timestamp."""
    date = utc_date(arrived)
    return df.withColumns({
        "year": F.date_format(date, "yyyy"),
        "month": F.date_format(date, "MM"),
        "day": F.date_format(date, "dd"),
    })


def raw_options(rows_per_file: int) -> dict[str, str]:
    """How raw CSV is written. Names keep their outer spaces; a field with a line break is quoted."""
    spaces = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    return {"header": "true", "maxRecordsPerFile": str(rows_per_file), **spaces}


def write_raw(df: DataFrame, root: str, arrived: str = "arrived", rows_per_file: int = ROWS_PER_RAW_FILE) -> Written:
    """Event columns as headered CSV under the (zero-padded) UTC date of the ``arrived`` timestamp."""
    chosen = dated_raw(df, arrived).select(*EVENT_COLS, *PARTITION_COLS, *_flag(df))
    return write_files(chosen, root, "csv", PARTITION_COLS, options=raw_options(rows_per_file))


def write_processed(df: DataFrame, root: str) -> Written:
    """Enriched events as Parquet under the (unpadded) date of their ``event_time``."""
    return write_files(add_date_parts(df).select(*PROCESSED_SCHEMA.names, *_flag(df)), root, "parquet", PARTITION_COLS)


def _flag(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c == LEFT_OUT]


def as_quarantined(df: DataFrame, stage: str) -> DataFrame:
    """Rows set aside by a stage, as JSON text so that unlike rows can share a layout."""
    text = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    return df.select(text.alias("row"), F.lit(stage).alias("stage"))


def write_quarantine(df: DataFrame, path: str, stage: str) -> Written:
    """Rows set aside by one run, in a folder of its own; writing it again replaces it."""
    return write_files(as_quarantined(df, stage), path, "parquet", [], mode="overwrite")
