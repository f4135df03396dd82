"""Message-topic source. Needs the Kafka connector package on the Spark classpath."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Fixed value: the topic events travel on.
TOPIC = "vehicle-info"


def kafka_options(servers: str, topic: str = TOPIC, max_offsets: int | None = None, **extra: str) -> dict[str, str]:
    """Reader options: one topic, from the earliest offset on a first start.

    Progress lives in the query's checkpoint, which is committed only after the sink has written.
    """
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": "earliest"}
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options | extra


def kafka_stream(spark: SparkSession, servers: str, topic: str = TOPIC, **options) -> DataFrame:
    """Unbounded messages; feed the result to ``decode_events``."""
    return spark.readStream.format("kafka").options(**kafka_options(servers, topic, **options)).load()


def kafka_batch(spark: SparkSession, servers: str, topic: str = TOPIC, **extra: str) -> DataFrame:
    """Everything the topic holds now."""
    return spark.read.format("kafka").options(**kafka_options(servers, topic, **extra)).load()
