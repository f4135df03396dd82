"""What a well-formed event looks like, as one boolean column per rule."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from roadlake.functions.measures import speeding_fine

# The domains an event is drawn from.
CAR_NAMES = [
    "Maruti Swift", "Hyundai i20", "Tata Nexon", "Mahindra XUV300",
    "Honda City", "Toyota Fortuner", "Kia Seltos", "Suzuki Baleno",
]
BIKE_NAMES = [
    "Royal Enfield Classic", "Bajaj Pulsar", "TVS Apache", "Hero Splendor",
    "Honda Activa", "Yamaha FZ", "Suzuki Gixxer", "KTM Duke",
]
STATE_CODES = ["MH", "DL", "KA", "TN", "GJ", "RJ", "UP", "MP", "WB", "PB", "HR", "CG"]
DISTRICT_CODES = ["01", "02", "03", "04", "05", "06", "07", "08", "09", "10", "12", "14", "20"]
VEHICLE_ID_PATTERN = r"^V[1-9][0-9]{3}\z"
PLATE_PATTERN = rf"^({'|'.join(STATE_CODES)}) ({'|'.join(DISTRICT_CODES)}) [A-Z]{{2}} [1-9][0-9]{{3}}\z"
PHONE_PATTERN = r"^[789][0-9]{8}\z"
RANGES = {
    "speed": (20.0, 200.0),
    "location_lat": (18.5, 19.0),
    "location_lon": (73.7, 74.0),
    "user_id": (1, 1000),
    "car_life_years": (1, 15),
    "price_of_vechical": (100000.0, 2000000.0),
}


def contract_rules() -> dict[str, Column]:
    """Rule name to the condition an event must meet."""
    kind, name = F.col("vehicle_type"), F.col("vehicle_name")
    rules = {
        "vehicle_id": F.col("vehicle_id").rlike(VEHICLE_ID_PATTERN),
        "number_plate": F.col("number_plate").rlike(PLATE_PATTERN),
        "vehicle_type": kind.isin("car", "bike"),
        "vehicle_name": ((kind == "car") & name.isin(CAR_NAMES)) | ((kind == "bike") & name.isin(BIKE_NAMES)),
        "phone_number": F.col("phone_number").rlike(PHONE_PATTERN),
    }
    for column, (low, high) in RANGES.items():
        rules[column] = F.col(column).between(low, high)
    rules["fine"] = F.col("fine") == speeding_fine("speed")
    rules["timestamp"] = F.col("timestamp").isNotNull() & ~F.isnan("timestamp")
    return rules


def violations(rules: dict[str, Column] | None = None) -> Column:
    """Names of the rules a row breaks, in rule order; a null counts as a break."""
    rules = contract_rules() if rules is None else rules
    broken = [F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()]
    return F.array_compact(F.array(*broken))
