"""Raw CSV tree ``year=YYYY/month=MM/day=DD``, as written by ``sinks.raw``."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from roadlake.operators.time_range import on_days
from roadlake.schema import EVENT_COLS, EVENT_SCHEMA

CORRUPT = "_corrupt_record"
FILES_PER_TRIGGER = 10

# A header that does not match the schema is an error rather than shifted columns, and a line
# that does not fit keeps its text in the corrupt column.
_OPTIONS = {
    "header": "true",
    "enforceSchema": "false",
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": CORRUPT,
    "pathGlobFilter": "*.csv",
    # A value may hold a line break, so a file is read by one task; writers bound its rows.
    "multiLine": "true",
}
# A file of any age is read: the default passes over those a week older than the newest.
ANY_AGE = {"maxFileAge": "36500d"}
_SCHEMA = StructType([*EVENT_SCHEMA.fields]).add(CORRUPT, "string")


def raw_stream(
    spark: SparkSession, root: str, max_files: int = FILES_PER_TRIGGER, max_bytes: int | None = None, any_age: bool = True, **options: str
) -> DataFrame:
    """Event columns and the corrupt line, from every file that appears under ``root``.

    A micro-batch takes ``max_files`` files, or files of ``max_bytes`` in all where that is given
    (the better bound when files differ in size). The root is watched, not one day's folder, so a
    new day needs no restart, and files may sit at any depth; where a stream has written the tree, its log of files is
    followed instead. Files of any age are taken, so the query remembers every name it has seen; pass ``cleanSource`` and
    ``sourceArchiveDir`` to keep the listing short on long runs. Without ``any_age`` names are remembered for a week: for trees whose files come in
    order of time, as those of one writing stream do, that is enough to read each once, however long the reader has paused; and what it holds stays small on
    long runs. An empty string reads back as null, as CSV does not tell them apart here.
    """
    reader = spark.readStream.schema(_SCHEMA).options(**_OPTIONS, **(ANY_AGE if any_age else {}), **per_trigger(max_files, max_bytes))
    reader = reader.option("recursiveFileLookup", "true")
    return reader.options(**options).csv(root).select(*EVENT_COLS, CORRUPT)


def per_trigger(max_files: int | None, max_bytes: int | None) -> dict[str, str]:
    """File-source option that bounds a micro-batch; the two exclude each other."""
    if max_bytes is not None:
        return {"maxBytesPerTrigger": str(max_bytes)}
    return {} if max_files is None else {"maxFilesPerTrigger": str(max_files)}


def read_raw(
    spark: SparkSession, root: str, first_day: dt.date | None = None, last_day: dt.date | None = None
) -> DataFrame:
    """Bounded form of ``raw_stream``; arrival days outside the range are never listed for reading."""
    files = spark.read.schema(_SCHEMA).options(**_OPTIONS).csv(root)
    return on_days(files, first_day, last_day).select(*EVENT_COLS, CORRUPT)
