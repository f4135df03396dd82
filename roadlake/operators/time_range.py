"""Date-range filters that prune partition folders."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F


def on_days(df: DataFrame, first_day: dt.date | None = None, last_day: dt.date | None = None) -> DataFrame:
    """Rows whose partition date lies in the closed range; an open end is None."""
    day = F.make_date("year", "month", "day")
    if first_day is not None:
        df = df.where(day >= F.lit(first_day))
    if last_day is not None:
        df = df.where(day <= F.lit(last_day))
    return df


def time_range(df: DataFrame, start: dt.datetime, end: dt.datetime, column: str = "event_time") -> DataFrame:
    """Rows with ``start <= column < end``; times without a zone are UTC.

    A filter on the timestamp alone cannot skip folders, so the matching bounds on the
    partition date are added; rows of a folder without a full date are looked at as well.
    """
    start, end = _as_utc(start), _as_utc(end)
    at = F.col(column)
    inside = df.where((at >= _instant(start)) & (at < _instant(end)))
    day = F.make_date("year", "month", "day")
    # Folders without a full date may hold any time.
    return inside.where(day.isNull() | ((day >= F.lit(start.date())) & (day <= F.lit(end.date()))))


def _as_utc(time: dt.datetime) -> dt.datetime:
    return time.replace(tzinfo=dt.timezone.utc) if time.tzinfo is None else time.astimezone(dt.timezone.utc)


def _instant(time: dt.datetime) -> Column:
    return F.lit(time.isoformat()).cast("timestamp")
