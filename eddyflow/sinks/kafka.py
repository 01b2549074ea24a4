"""Kafka sinks: message text without a key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def kafka_payload(df: DataFrame, value_col: str = "value") -> DataFrame:
    return df.select(F.col(value_col).cast("string").alias("value"))


def write_kafka(df: DataFrame, bootstrap_servers: str, topic: str, value_col: str = "value") -> None:
    """Bounded write; ``acks=all`` as the original producer."""
    (kafka_payload(df, value_col).write.format("kafka")
     .option("kafka.bootstrap.servers", bootstrap_servers)
     .option("kafka.acks", "all")
     .option("topic", topic).save())


def kafka_stream_writer(df: DataFrame, bootstrap_servers: str, topic: str, checkpoint: str,
                        value_col: str = "value"):
    """A streaming writer (not started)."""
    return (kafka_payload(df, value_col).writeStream.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap_servers)
            .option("kafka.acks", "all")
            .option("topic", topic)
            .option("checkpointLocation", checkpoint))
