"""Kafka topics as sources and sinks. Brokers and topics are always arguments.

The connector package is not part of Spark itself; put it on the session with
``spark.jars.packages``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from transitloom.operators.messages import encode_json


def topic_options(
    servers: str,
    topic: str,
    starting_offsets: str = "latest",
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Reader options of one topic subscription."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
    }
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    return options


def read_topic(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """A topic as an unbounded frame of records."""
    return spark.readStream.format("kafka").options(**topic_options(servers, topic, **options)).load()


def write_topic(df: DataFrame, servers: str, topic: str) -> None:
    """Publish a batch, one JSON document per row."""
    options = {"kafka.bootstrap.servers": servers, "topic": topic}
    encode_json(df).write.format("kafka").options(**options).save()


def publish_stream(df: DataFrame, servers: str, topic: str, checkpoint: str) -> StreamingQuery:
    """Publish a stream, one JSON document per row."""
    options = {"kafka.bootstrap.servers": servers, "topic": topic}
    return (
        encode_json(df)
        .writeStream.format("kafka")
        .options(**options, checkpointLocation=checkpoint)
        .outputMode("append")
        .start()
    )
