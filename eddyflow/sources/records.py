"""Message records shaped like Kafka's: topic, partition, offset, key, value."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RECORD_SCHEMA = "topic string, partition int, offset bigint, key string, value string, timestamp timestamp"
EVENT_PARTITIONS = 4


def records_from_events(events: DataFrame, partitions: int = EVENT_PARTITIONS) -> DataFrame:
    """The events table as a record log: topic = event type, partition =
    user id mod ``partitions``, key = user id, value = the props text.

    The offset is the event id: increasing within a partition with gaps, which
    Kafka allows (compaction, transaction markers).  A dense per-partition
    numbering would need a window over whole partitions, i.e. one task each.
    """
    return events.select(
        F.col("event_type").alias("topic"),
        (F.col("user_id") % partitions).cast("int").alias("partition"),
        F.col("event_id").cast("bigint").alias("offset"),
        F.col("user_id").cast("string").alias("key"),
        F.col("props").alias("value"),
        F.col("ts").alias("timestamp"),
    )


def records_from_order_log(log: DataFrame, partitions: int = EVENT_PARTITIONS) -> DataFrame:
    """Order lines (``value``, with their line item's key) as a record log of one
    topic: partition = order key mod ``partitions``, offset from the order key and
    line number, increasing within a partition."""
    return log.select(
        F.lit("orders").alias("topic"),
        (F.col("l_orderkey") % partitions).cast("int").alias("partition"),
        (F.col("l_orderkey") * 16 + F.col("l_linenumber")).cast("bigint").alias("offset"),
        F.col("l_orderkey").cast("string").alias("key"), "value", F.lit(None).cast("timestamp").alias("timestamp"))
