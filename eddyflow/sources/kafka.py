"""Kafka sources.  The connector jar is not bundled here, so these builders are
thin: options in, DataFrame out, with every job reading only the record schema
(``topic, partition, offset, key, value, timestamp``) so the same logic runs
on file-fed record frames in tests."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def kafka_options(bootstrap_servers: str, topics: Iterable[str], starting_offsets: str = "latest",
                  min_partitions: int | None = None, max_offsets_per_trigger: int | None = None,
                  **extra: str) -> dict[str, str]:
    """Options for a subscription; ``starting_offsets`` is ``latest``,
    ``earliest`` or the JSON of ``starting_offsets_json``.  Offsets are not
    committed to Kafka: progress lives in the checkpoint or the offset ledger.

    ``min_partitions`` lets the source cut large offset ranges into several
    Spark tasks, so one Kafka partition holding a third of the records does
    not become one task; ``max_offsets_per_trigger`` bounds a micro-batch.
    """
    opts = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": ",".join(topics),
        "startingOffsets": starting_offsets,
    }
    if min_partitions:
        opts["minPartitions"] = str(min_partitions)
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    opts.update(extra)
    return opts


def as_records(raw: DataFrame) -> DataFrame:
    """Cast the binary key and value to text (string deserialisers)."""
    return raw.select("topic", "partition", "offset",
                      F.col("key").cast("string").alias("key"),
                      F.col("value").cast("string").alias("value"),
                      "timestamp")


def read_kafka_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return as_records(spark.readStream.format("kafka").options(**options).load())


def read_kafka_batch(spark: SparkSession, options: dict[str, str], ending_offsets: str = "latest") -> DataFrame:
    opts = dict(options)
    opts.setdefault("endingOffsets", ending_offsets)
    if opts.get("startingOffsets") == "latest":
        raise ValueError("a bounded read starts at 'earliest' or at given offsets, not at 'latest'")
    return as_records(spark.read.format("kafka").options(**opts).load())


def record_values(records: DataFrame) -> DataFrame:
    """Just the message text, as ``value``."""
    return records.select(F.col("value").cast("string").alias("value"))
