"""Message-topic sink. Needs the Kafka connector package on the Spark classpath."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming.query import StreamingQuery

from roadlake.functions.records import encode_events
from roadlake.schema import EVENT_COLS
from roadlake.sources.kafka import TOPIC


def write_kafka(df: DataFrame, servers: str, topic: str = TOPIC, columns: list[str] = EVENT_COLS) -> None:
    """Send ``columns`` of a bounded frame, one JSON value per row, without keys."""
    encode_events(df, columns).write.format("kafka").options(**sink_options(servers, topic)).save()


def stream_to_kafka(df: DataFrame, servers: str, checkpoint: str, topic: str = TOPIC) -> StreamingQuery:
    """Send a streaming frame; delivery is at least once, as the topic has no transactions here."""
    writer = encode_events(df).writeStream.format("kafka").options(**sink_options(servers, topic))
    return writer.option("checkpointLocation", checkpoint).outputMode("append").start()


def sink_options(servers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic}
