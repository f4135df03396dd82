"""Processed Parquet tree, partitioned by event date."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from roadlake.schema import PARTITION_COLS, PROCESSED_SCHEMA
from roadlake.session import no_rows
from roadlake.sources.raw import ANY_AGE, per_trigger


def _parquet(spark: SparkSession, root: str, schema: StructType, **options: str) -> DataFrame | None:
    """Scan with a fixed schema, or None where there is no such folder."""
    try:
        return spark.read.schema(schema).options(pathGlobFilter="*.parquet", **options).parquet(root)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read_parquet_or_empty(spark: SparkSession, root: str, schema: StructType) -> DataFrame:
    """Parquet files under ``root`` with a fixed schema; no folder means no rows.

    Columns a file lacks come back null, so one scan unites files of unlike layouts by name.
    """
    files = _parquet(spark, root, schema)
    return no_rows(spark, schema) if files is None else files.select(*schema.names)


def read_processed(spark: SparkSession, root: str, schema: StructType = PROCESSED_SCHEMA) -> DataFrame:
    """Processed events with ``year``, ``month``, ``day`` taken from the folder names."""
    return read_parquet_or_empty(spark, root, schema)


def read_processed_any_layout(
    spark: SparkSession,
    root: str,
    schema: StructType = PROCESSED_SCHEMA,
    first_day: dt.date | None = None,
    last_day: dt.date | None = None,
) -> DataFrame:
    """Like ``read_processed`` for trees whose files sit at differing depths.

    Date parts are read off each file's path, replacing columns of those names in the file, and
    are null where the path has none. With ``first_day`` or ``last_day`` files are passed over whose path
    tells that none of their days is in the range: by what it has of year, month and day, the bounds included. Their names decide,
    before they are opened. Rows of the files that are left are not filtered.
    """
    files = _parquet(spark, root, _in_file(schema), recursiveFileLookup="true")
    if files is None:
        return no_rows(spark, schema)
    for bound, beyond in ((first_day, Column.__lt__), (last_day, Column.__gt__)):
        if bound is not None:
            files = files.where(~_beyond(bound, beyond))
    return _with_path_parts(files, schema)


def _beyond(bound: dt.date, beyond: Callable[[Column, Column], Column]) -> Column:
    """Whether a file's path lies beyond a day, as far as it goes: an absent or unreadable part decides nothing."""
    parts = _path_parts()
    year, month, day = (F.coalesce(parts[p], F.lit(value)) for p, value in zip(PARTITION_COLS, (bound.year, bound.month, bound.day)))
    known = parts["year"].isNotNull()
    # A day without a month says nothing.
    month_known = F.when(known, month).otherwise(bound.month)
    day_known = F.when(known & parts["month"].isNotNull(), day).otherwise(bound.day)
    number = year * 10_000 + month_known * 100 + day_known
    return beyond(number, F.lit(bound.year * 10_000 + bound.month * 100 + bound.day))


def processed_stream(
    spark: SparkSession, root: str, max_files: int | None = None, max_bytes: int | None = None, any_age: bool = True
) -> DataFrame:
    """New processed files only, at any depth; ``any_age`` as for ``raw_stream``.

    Files of this tree are final, so each is read once.
    """
    reader = spark.readStream.schema(_in_file(PROCESSED_SCHEMA)).options(
        pathGlobFilter="*.parquet",
        recursiveFileLookup="true",
        **(ANY_AGE if any_age else {}),
        **per_trigger(max_files, max_bytes),
    )
    return _with_path_parts(reader.parquet(root), PROCESSED_SCHEMA)


def _in_file(schema: StructType) -> StructType:
    return StructType([f for f in schema.fields if f.name not in PARTITION_COLS])


def _path_parts() -> dict[str, Column]:
    path = F.col("_metadata.file_path")
    return {p: F.regexp_extract(path, f"/{p}=([0-9]+)/", 1).try_cast("int") for p in PARTITION_COLS}


def _with_path_parts(files: DataFrame, schema: StructType) -> DataFrame:
    return files.withColumns(_path_parts()).select(*schema.names)
