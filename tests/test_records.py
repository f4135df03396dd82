"""JSON messages, quarantine, and the topic glue."""

import json

import pytest
from pyspark.errors import AnalysisException

from conftest import event
from roadlake.functions.records import decode_events, encode_events, unknown_fields
from roadlake.operators.quality import split_decoded, split_keyed, split_quality
from roadlake.schema import EVENT_COLS, EVENT_SCHEMA
from roadlake.sinks.kafka import sink_options, write_kafka
from roadlake.sources.kafka import kafka_options, kafka_stream

GOOD = json.dumps(dict(zip(EVENT_COLS, event())))


def decode_one(spark, raw):
    return decode_events(spark.createDataFrame([(raw,)], "value binary")).first()


def test_round_trip_keeps_every_value(spark):
    rows = [event(), event("V2", None, speed=None, user_id=None), event("V3", float("nan"))]
    df = spark.createDataFrame(rows, EVENT_SCHEMA)
    good, bad = split_decoded(decode_events(encode_events(df)))
    assert repr(sorted(map(tuple, good.collect()))) == repr(sorted(map(tuple, df.collect())))
    assert bad.count() == 0


def test_nulls_are_written_out(spark):
    df = spark.createDataFrame([event(speed=None)], EVENT_SCHEMA)
    message = json.loads(encode_events(df).first().value)
    assert list(message) == EVENT_COLS and message["speed"] is None


@pytest.mark.parametrize("raw, reason", [
    (GOOD.encode(), None),
    (b"  " + GOOD.encode() + b"\r\n", None),
    (b'{"vehicle_id":"V2"}', None),
    (b'{"vehicle_id":"V2","unknown":{"a":[1]}}', None),
    (b"{}", None),
    (b"{bad", "malformed_json"),
    (b'{"speed":"fast"}', "malformed_json"),
    (b'{"user_id":5.5}', "malformed_json"),
    (b"[1]", "malformed_json"),
    (b'[{"speed":1.0}]', "malformed_json"),
    (b"null", "malformed_json"),
    (b"", "malformed_json"),
    (b'{"speed":1.0} trailing', "malformed_json"),
    (b'{"vehicle_id":"V1"} {"vehicle_id":"V2"}', "malformed_json"),
    (b'{"vehicle_id":"V1"},{"vehicle_id":"V2"}', "malformed_json"),
    (b'{"vehicle_id":"V1"} junk}', "malformed_json"),
    (b'{"vehicle_id":"}{"}', None),
    (b'\xff{"speed":1.0}', "invalid_utf8"),
    (None, "null_value"),
])
def test_decode_reason(spark, raw, reason):
    row = decode_one(spark, raw)
    assert row.decode_error == reason
    assert row.value == raw


def test_missing_keys_are_null(spark):
    row = decode_one(spark, b'{"vehicle_id":"V2"}')
    assert row.vehicle_id == "V2" and row.speed is None and row.timestamp is None


def test_split_decoded_keeps_raw_text(spark):
    df = spark.createDataFrame([(1, GOOD), (2, "{bad")], "n int, value string")
    good, bad = split_decoded(decode_events(df, keep=("n",)))
    assert good.columns == ["n", *EVENT_COLS]
    assert [tuple(r) for r in bad.collect()] == [(2, "{bad", "malformed_json")]


def test_quality_split_loses_nothing(spark):
    rows = [event(), event(speed=500.0), event(vehicle=None), event(user_id=0, fine=7)]
    df = spark.createDataFrame(rows, EVENT_SCHEMA)
    valid, rejected = split_quality(df)
    assert valid.count() == 1 and valid.columns == EVENT_COLS
    assert rejected.count() == 3
    assert {tuple(r.reasons) for r in rejected.collect()} == {("speed", "fine"), ("vehicle_id",), ("user_id", "fine")}


def test_null_keys_are_set_aside(spark):
    df = spark.createDataFrame([("a", None), (None, 1), ("a", 1)], "vehicle_id string, event_time int")
    keyed, unkeyed = split_keyed(df)
    assert keyed.count() == 1 and unkeyed.count() == 2


def test_topic_options():
    options = kafka_options("h:1", max_offsets=500, failOnDataLoss="false")
    assert options == {
        "kafka.bootstrap.servers": "h:1",
        "subscribe": "vehicle-info",
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "500",
        "failOnDataLoss": "false",
    }
    assert sink_options("h:1", "t") == {"kafka.bootstrap.servers": "h:1", "topic": "t"}


def test_topic_needs_the_connector(spark):
    with pytest.raises(AnalysisException):
        kafka_stream(spark, "h:1")
    with pytest.raises(AnalysisException):
        write_kafka(spark.createDataFrame([event()], EVENT_SCHEMA), "h:1")


def test_unknown_fields_are_named(spark):
    rows = [('{"vehicle_id":"V1","colour":"red","speed":1}',), ("{}",), ("{bad",), (None,)]
    got = spark.createDataFrame(rows, "value string").select(unknown_fields().alias("names")).collect()
    assert [r.names for r in got] == [["colour"], [], None, None]
