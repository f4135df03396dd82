"""Edge values of the column functions."""

import pytest
from pyspark.sql import functions as F

from conftest import at, event
from roadlake.functions.contract import contract_rules, violations
from roadlake.functions.event_time import add_event_time, coerce_times, event_time, stamp
from roadlake.functions.measures import nan_to_null, round_measures, speeding_fine
from roadlake.operators.alerts import overspeed_alerts, preview
from roadlake.schema import EVENT_COLS, EVENT_SCHEMA, TARGET_SCHEMA

NAN = float("nan")


def values(df):
    return [tuple(row) for row in df.collect()]


def test_schemas_keep_the_wire_names():
    assert len(EVENT_COLS) == 13 and len(TARGET_SCHEMA) == 18
    assert "price_of_vechical" in EVENT_COLS
    assert TARGET_SCHEMA.names[-1] == "last_updated"


@pytest.mark.parametrize("epoch, second, micro", [
    (1717171717.987654, "2024-05-31T16:08:37", "2024-05-31T16:08:37.987654"),
    (-1.5, "1969-12-31T23:59:59", "1969-12-31T23:59:58.500000"),
    (0.0, "1970-01-01T00:00:00", "1970-01-01T00:00:00"),
    (None, None, None),
    (NAN, None, None),
    (float("inf"), None, None),
    (1e15, None, None),
    (-1e300, None, None),
])
def test_event_time(spark, epoch, second, micro):
    df = spark.createDataFrame([(epoch,)], "t double")
    row = df.select(
        event_time("t").cast("string").alias("s"), event_time("t", "micro").cast("string").alias("m")
    ).first()
    assert row.s == (second and second.replace("T", " "))
    assert (row.m and at(row.m)) == (micro and at(micro))


def test_event_time_rejects_other_precisions():
    with pytest.raises(ValueError):
        event_time(F.lit(1.0), "hour")


def test_instants_an_hour_apart_stay_apart_in_a_clock_change(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([(1730611800.0,), (1730615400.0,)], "t double")
        assert df.select(event_time("t")).distinct().count() == 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_date_parts_replace_those_of_the_folder(spark):
    df = spark.createDataFrame([event(timestamp=1717171717.9)], EVENT_SCHEMA).withColumn("year", F.lit(1999))
    row = add_event_time(df).first()
    assert (row.year, row.month, row.day) == (2024, 5, 31)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_date_parts_do_not_depend_on_the_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        stamps = [1704067199.0, 1704067200.0, 1709164800.0, -1.0, -86400.0, -86401.0, None]
        df = spark.createDataFrame([event(timestamp=t) for t in stamps], EVENT_SCHEMA)
        parts = [tuple(r) for r in add_event_time(df).select("year", "month", "day").collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert parts == [
        (2023, 12, 31), (2024, 1, 1), (2024, 2, 29), (1969, 12, 31), (1969, 12, 31), (1969, 12, 30), (None,) * 3,
    ]


@pytest.mark.parametrize("speed, fine", [(150.0, 0), (150.004, 0), (150.01, 1000), (20.0, 0), (None, 0), (NAN, 0)])
def test_fine_is_strict_and_follows_rounding(spark, speed, fine):
    assert spark.createDataFrame([(speed,)], "speed double").select(speeding_fine("speed")).first()[0] == fine


def test_fine_parameters(spark):
    df = spark.createDataFrame([(90.0,)], "speed double")
    assert df.select(speeding_fine("speed", limit=80, amount=50)).first()[0] == 50


def test_round_measures(spark):
    df = spark.createDataFrame([(2.675, 18.12345678)], "speed double, location_lat double")
    assert values(round_measures(df)) == [(2.68, 18.123457)]


def test_nan_becomes_null_and_other_values_stay(spark):
    df = spark.createDataFrame([(NAN, 1, "x"), (1.5, 2, None), (None, None, "NaN")], "a double, b int, c string")
    assert values(nan_to_null(df)) == [(None, 1, "x"), (1.5, 2, None), (None, None, "NaN")]
    only_text = df.select("c")
    assert nan_to_null(only_text).columns == ["c"]


def test_coerce_times(spark):
    df = spark.createDataFrame(
        [(1717171717.25, "2024-05-31 16:08:37"), (NAN, "garbage"), (None, None)], "event_time double, processing_time string"
    )
    assert values(coerce_times(df)) == [
        (at("2024-05-31T16:08:37.250000"), at("2024-05-31T16:08:37")), (None, None), (None, None),
    ]
    whole = spark.createDataFrame([(1717171717,)], "event_time bigint")
    assert values(coerce_times(whole)) == [(at("2024-05-31T16:08:37"),)]
    ready = spark.createDataFrame([(at("2024-05-31T16:08:37"), 5)], "event_time timestamp, other int")
    assert values(coerce_times(ready)) == [(at("2024-05-31T16:08:37"), 5)]
    assert coerce_times(ready.select("other")).columns == ["other"]
    dates = ready.select(F.to_date("event_time").alias("event_time"))
    assert values(coerce_times(dates)) == [(at("2024-05-31"),)]


def test_stamp_gives_one_value_to_all_rows(spark):
    stamped = stamp(spark.range(1000).repartition(8), F.current_timestamp())
    assert stamped.select("last_updated").distinct().count() == 1


def test_well_formed_event_breaks_no_rule(spark):
    df = spark.createDataFrame([event()], EVENT_SCHEMA)
    assert df.select(violations()).first()[0] == []


@pytest.mark.parametrize("change, broken", [
    ({"vehicle": "V999"}, ["vehicle_id"]),
    ({"number_plate": "XX 12 AB 1234"}, ["number_plate"]),
    ({"number_plate": "MH 11 AB 1234"}, ["number_plate"]),
    ({"number_plate": "MH 12 AB 0999"}, ["number_plate"]),
    ({"vehicle_type": "bus"}, ["vehicle_type", "vehicle_name"]),
    ({"vehicle_name": "Yamaha FZ"}, ["vehicle_name"]),
    ({"phone_number": "612345678"}, ["phone_number"]),
    ({"phone_number": "9123456789"}, ["phone_number"]),
    ({"speed": 200.01, "fine": 1000}, ["speed"]),
    ({"speed": 160.0}, ["fine"]),
    ({"speed": None}, ["speed"]),
    ({"speed": NAN}, ["speed"]),
    ({"location_lat": 19.1}, ["location_lat"]),
    ({"location_lon": 73.69}, ["location_lon"]),
    ({"user_id": 1001}, ["user_id"]),
    ({"vehicle_id": "V1001\n"}, ["vehicle_id"]),
    ({"phone_number": "912345678\n"}, ["phone_number"]),
    ({"car_life_years": 0}, ["car_life_years"]),
    ({"price_of_vechical": 99999.99}, ["price_of_vechical"]),
    ({"timestamp": NAN}, ["timestamp"]),
    ({"timestamp": None}, ["timestamp"]),
])
def test_each_rule(spark, change, broken):
    df = spark.createDataFrame([event(**change)], EVENT_SCHEMA)
    assert df.select(violations()).first()[0] == broken


def test_rules_cover_every_field():
    assert set(contract_rules()) == set(EVENT_COLS)


def test_alert_text_and_preview(spark):
    df = add_event_time(spark.createDataFrame([event(speed=151.5, fine=1000)] + [event()] * 9, EVENT_SCHEMA))
    assert values(overspeed_alerts(df)) == [(
        "V1001", 151.5, 1000, "912345678",
        "WARNING: Vehicle V1001 overspeeding at 151.5 km/h — Fine ₹1000 sent to phone 912345678",
    )]
    assert preview(df).columns == ["vehicle_id", "number_plate", "speed", "event_time"]
    assert preview(df).count() == 5
