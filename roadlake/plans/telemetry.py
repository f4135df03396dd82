"""Vehicle events derived from the ``events`` table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from roadlake.schema import EVENT_COLS


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``event_id`` plus the thirteen event columns, one row per row of ``events``."""
    n, user = F.col("event_id"), F.col("user_id")
    is_car = F.col("event_type").isin("click", "view")
    columns = {
        "vehicle_id": F.concat(F.lit("V"), 1000 + user),
        "number_plate": F.concat(F.lit("MH 12 AB "), 1000 + n % 9000),
        "vehicle_type": F.when(is_car, "car").otherwise("bike"),
        "vehicle_name": F.when(is_car, "Honda City").otherwise("Yamaha FZ"),
        "speed": F.col("value"),
        "location_lat": F.lit(18.5) + (n % 500) / F.lit(1000.0),
        "location_lon": F.lit(73.7) + (n % 300) / F.lit(1000.0),
        "user_id": user.cast("int"),
        "phone_number": F.concat(F.lit("9"), F.lpad(n.cast("string"), 8, "0")),
        "car_life_years": (1 + n % 15).cast("int"),
        "price_of_vechical": (100000 + n % 1900000).cast("double"),
        "fine": F.when(F.col("value") > 150, 1000).otherwise(0),
        "timestamp": F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(1e6),
    }
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return events.select("event_id", *[columns[c].alias(c) for c in EVENT_COLS])
