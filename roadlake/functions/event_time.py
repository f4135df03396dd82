"""Epoch seconds to timestamps, and the date parts that partition every table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DateType, NumericType, StringType

# Largest whole second whose microsecond count still fits a bigint.
_LAST_SECOND = (2**63 - 1) // 1_000_000


def event_time(epoch: Column | str, precision: str = "second") -> Column:
    """Timestamp of an epoch-seconds double.

    ``second`` drops the fraction toward zero, ``micro`` keeps it. Null, NaN, infinite and
    out-of-range values become null instead of failing the job.
    """
    value = F.col(epoch) if isinstance(epoch, str) else epoch
    if precision == "second":
        whole = value.try_cast("bigint")
        return F.when(whole.between(-_LAST_SECOND, _LAST_SECOND), F.timestamp_seconds(whole))
    if precision == "micro":
        return F.timestamp_micros(F.round(value * F.lit(1e6)).try_cast("bigint"))
    raise ValueError(f"precision must be 'second' or 'micro', not {precision!r}")


def utc_date(at: Column | str) -> Column:
    """UTC date of a timestamp, whatever the session zone: equal keys must share a partition."""
    value = F.col(at) if isinstance(at, str) else at
    days = F.floor(F.unix_seconds(value.cast("timestamp")) / F.lit(86_400))
    return F.date_from_unix_date(days.cast("int"))


def add_date_parts(df: DataFrame, column: str = "event_time") -> DataFrame:
    """Set integer ``year``, ``month`` and ``day`` (UTC) from a timestamp."""
    date = utc_date(column)
    return df.withColumns({"year": F.year(date), "month": F.month(date), "day": F.dayofmonth(date)})


def add_event_time(df: DataFrame, precision: str = "second") -> DataFrame:
    """``event_time`` plus its date parts; date parts already present are replaced."""
    return add_date_parts(df.withColumn("event_time", event_time("timestamp", precision)))


def coerce_times(df: DataFrame, columns: tuple[str, ...] = ("processing_time", "event_time")) -> DataFrame:
    """Make the named columns timestamps where they exist.

    Numbers count as epoch seconds with a fraction, text is parsed, and whatever cannot be
    read becomes null.
    """
    changed = {}
    for field in df.schema.fields:
        if field.name not in columns:
            continue
        if isinstance(field.dataType, NumericType):
            changed[field.name] = event_time(F.col(field.name).cast("double"), "micro")
        elif isinstance(field.dataType, StringType):
            changed[field.name] = F.try_to_timestamp(F.col(field.name))
        elif isinstance(field.dataType, DateType):
            changed[field.name] = F.col(field.name).cast("timestamp")
    return df.withColumns(changed) if changed else df


def stamp(df: DataFrame, run_time: Column) -> DataFrame:
    """Audit column ``last_updated``: one value for the whole run."""
    return df.withColumn("last_updated", run_time.cast("timestamp"))
