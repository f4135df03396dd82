"""One row per key: the latest."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import BinaryType, DoubleType, FloatType, StringType


def dedupe_latest(df: DataFrame, keys: Sequence[str], latest_by: Sequence[str]) -> DataFrame:
    """Keep the row with the greatest ``latest_by`` per key; a null or NaN counts as least.

    Ties go to the greatest remaining columns, in column order, so the outcome does not depend
    on row order. Rows with a null in the key equal no other row and are all kept.

    The greatest row is an aggregate, so each map task sends one row per key whatever share of
    the data a key holds, and only the key is sorted.
    """
    # A row without a complete key gets a number of its own, so it stays alone in its group.
    numbered = df.withColumn("_alone", F.when(~complete(keys), F.monotonically_increasing_id()))
    return _latest(df, numbered, keys, latest_by, ["_alone"])


def dedupe_keyed(df: DataFrame, keys: Sequence[str], latest_by: Sequence[str]) -> DataFrame:
    """:func:`dedupe_latest` for rows that all have a key.

    Grouped by the keys alone, so that a join on them goes on in the same tasks without a further exchange.
    """
    return _latest(df, df, keys, latest_by, [])


def _latest(df: DataFrame, rows: DataFrame, keys: Sequence[str], latest_by: Sequence[str], apart: Sequence[str]) -> DataFrame:
    keys = fixed_width_first(df, keys)
    rest = [c for c in df.columns if c not in keys and c not in latest_by]
    order = [c for c in latest_by if c not in keys] + rest
    ranked = [recency(df, c).alias(f"_by_{i}") for i, c in enumerate(latest_by) if c not in keys]
    latest = rows.groupBy(*keys, *apart).agg(F.max(F.struct(*ranked, *order)).alias("_row"))
    return latest.select(*keys, *[F.col("_row")[c].alias(c) for c in order]).select(*df.columns)


def recency(df: DataFrame, column: str) -> Column:
    """A column as it is ordered: NaN, which sorts above every number, counts as null."""
    if isinstance(df.schema[column].dataType, (DoubleType, FloatType)):
        return F.nanvl(column, F.lit(None).cast(df.schema[column].dataType))
    return F.col(column)


def fixed_width_first(df: DataFrame, keys: Sequence[str]) -> list[str]:
    """Keys in the order that sorts fastest.

    A sort compares eight bytes of its first column before it looks at whole rows. Those tell
    times and numbers apart, while ids in text tend to begin alike.
    """
    return sorted(keys, key=lambda k: isinstance(df.schema[k].dataType, (StringType, BinaryType)))


def split_on_null(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with every column set, rows with at least one null)."""
    return df.where(complete(columns)), df.where(~complete(columns))


def complete(columns: Sequence[str]) -> Column:
    """Whether every one of the columns is set."""
    return reduce(and_, [F.col(c).isNotNull() for c in columns])
