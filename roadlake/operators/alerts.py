"""Overspeed alerts and the sample preview; both work on batch and streaming frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# The alert text, with its four fields in order.
ALERT_TEXT = "WARNING: Vehicle %s overspeeding at %s km/h — Fine ₹%s sent to phone %s"
ALERT_FIELDS = ["vehicle_id", "speed", "fine", "phone_number"]
PREVIEW_COLS = ["vehicle_id", "number_plate", "speed", "event_time"]


def overspeed_alerts(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Fined events as alert fields plus a message; ``keep`` names further columns to carry."""
    texts = [F.col(c).cast("string") for c in ALERT_FIELDS]
    return df.where(F.col("fine") > 0).select(
        *keep, *ALERT_FIELDS, F.format_string(ALERT_TEXT, *texts).alias("message")
    )


def preview(df: DataFrame, rows: int = 5) -> DataFrame:
    """A few rows of the columns worth looking at, in no order of their own."""
    return df.select(*PREVIEW_COLS).limit(rows)
