"""The four fixed layouts an event passes through, and the names they share."""

from __future__ import annotations

from pyspark.sql.types import StructType


def _struct(fields: dict[str, str]) -> StructType:
    schema = StructType()
    for name, kind in fields.items():
        schema = schema.add(name, kind, nullable=True)
    return schema


# Wire names (spelling included), order and types of an event.
_EVENT = {
    "vehicle_id": "string",
    "number_plate": "string",
    "vehicle_type": "string",
    "vehicle_name": "string",
    "speed": "double",
    "location_lat": "double",
    "location_lon": "double",
    "user_id": "integer",
    "phone_number": "string",
    "car_life_years": "integer",
    "price_of_vechical": "double",
    "fine": "integer",
    "timestamp": "double",
}
_PARTS = {"year": "integer", "month": "integer", "day": "integer"}

EVENT_SCHEMA = _struct(_EVENT)
PROCESSED_SCHEMA = _struct(_EVENT | {"event_time": "timestamp"} | _PARTS)
TARGET_SCHEMA = _struct(_EVENT | {"event_time": "timestamp"} | _PARTS | {"last_updated": "timestamp"})

EVENT_COLS = EVENT_SCHEMA.names
PARTITION_COLS = list(_PARTS)
KEY_COLS = ["vehicle_id", "event_time"]
