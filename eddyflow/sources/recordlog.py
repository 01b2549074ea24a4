"""A record log in folders of (topic, partition, segment), read from stored offsets.

A segment holds the records of ``segment_offsets`` consecutive offsets of a topic
partition, sorted.  Stored offsets become a predicate on the folder columns alone,
so Spark leaves the folders of consumed segments out before it opens a file, for a
bounded read and for each micro-batch of a stream; the segment in which a stored
offset lies is read and filtered by record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..operators.offsets import unconsumed

FOLDERS = ["topic", "partition", "segment"]
# A segment is written as about this many sorted files.
SEGMENT_SLICES = 8


def write_record_log(records: DataFrame, path: str, segment_offsets: int) -> None:
    """Append ``records`` to the log.  A segment is cut into slices of its offsets, and
    a slice's records are written together.  Slices are dealt by their own numbers:
    cuts taken from the data would have the records made twice, first to draw a sample."""
    placed = records.withColumn("segment", F.floor(F.col("offset") / segment_offsets).cast("bigint"))
    piece = F.floor(F.col("offset") / max(1, segment_offsets // SEGMENT_SLICES))
    (placed.repartition(*FOLDERS, piece).sortWithinPartitions(*FOLDERS, "offset")
     .write.mode("append").partitionBy(*FOLDERS).parquet(path))


def unread_segments(stored: list[Row], segment_offsets: int) -> Column:
    """The predicate on folders: per stored topic partition the segments from the
    stored offset on; other partitions whole."""
    out, known = F.lit(False), F.lit(False)
    for r in stored:
        here = (F.col("topic") == r["topic"]) & (F.col("partition") == r["partitioner"])
        out = out | (here & (F.col("segment") >= r["offset"] // segment_offsets))
        known = known | here
    return out | ~known


def resumed(log: DataFrame, latest: DataFrame, segment_offsets: int) -> DataFrame:
    """The records of ``log`` (bounded or a stream) that ``latest`` has not.  The
    stored offsets, one row per topic partition, are read once: a stream goes on
    from where the ledger stood at its start, whatever is added to it meanwhile."""
    stored = latest.select("topic", "partitioner", "offset").collect()
    held = log.sparkSession.createDataFrame(stored, "topic string, partitioner int, offset bigint")
    return unconsumed(log.where(unread_segments(stored, segment_offsets)), held).drop("segment")


def read_record_log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The whole log; ``schema`` names its columns and ``segment bigint``."""
    return spark.read.schema(schema).parquet(path)
