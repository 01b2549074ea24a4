"""Numbered messages, bounded or endless (the producers of the original)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.records import numbered_message

# Fixed message texts of the original producers.
MESSAGE_PREFIX = "this is message"
TEST_MESSAGE_PREFIX = "this is my "
TEST_MESSAGE_SUFFIX = " message"
STREAM_MESSAGE_PREFIX = "message"
STREAM_ROWS_PER_SECOND = 5


def numbered_messages(spark: SparkSession, start: int, end: int, prefix: str = MESSAGE_PREFIX,
                      suffix: str = "") -> DataFrame:
    """``value`` = prefix + n + suffix for n in [start, end), generated on the
    executors by ``range`` (no driver-side list)."""
    return spark.range(start, end).select(numbered_message(prefix, F.col("id"), suffix).alias("value"))


def messages_for_rows(df: DataFrame, id_col: str, first: int = 1000, prefix: str = MESSAGE_PREFIX) -> DataFrame:
    """One message per row of a table, numbered ``first + id``."""
    return df.select(numbered_message(prefix, F.col(id_col) + first).alias("value"))


def message_stream(spark: SparkSession, rows_per_second: int = STREAM_ROWS_PER_SECOND,
                   rows_per_batch: int | None = None) -> DataFrame:
    """Endless ``message1, message2, ...``; ``rows_per_batch`` switches to the
    deterministic ``rate-micro-batch`` source (tests)."""
    if rows_per_batch:
        raw = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", str(rows_per_batch)).load()
    else:
        raw = spark.readStream.format("rate").option("rowsPerSecond", str(rows_per_second)).load()
    return raw.select(numbered_message(STREAM_MESSAGE_PREFIX, F.col("value") + 1).alias("value"))
