"""Ledger tables: consumer offsets and metric deltas (Parquet or JDBC)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

OFFSET_LEDGER_SCHEMA = "groupid string, topic string, partitioner int, offset bigint, run string, batch_id bigint"
METRIC_LEDGER_SCHEMA = ("metric string, key string, exponent int, units decimal(38,0), query string, run string, "
                        "batch_id bigint")


def read_offset_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the offset ledger that are not folded yet (``streaming.ledger``
    reads all)."""
    return spark.read.schema(OFFSET_LEDGER_SCHEMA).parquet(path)


def read_offset_ledger_jdbc(spark: SparkSession, url: str, table: str = "Offset",
                            properties: dict[str, str] | None = None) -> DataFrame:
    """The SQL ledger ``(groupid, topic, partitioner, offset)``; filters on it
    are pushed into the database query by the JDBC source."""
    return spark.read.jdbc(url, table, properties=properties or {})


def read_metric_store(spark: SparkSession, path: str) -> DataFrame:
    """``metric, key, exponent, units`` rows of the metric ledger that are not folded yet
    (``streaming.ledger`` reads all)."""
    return spark.read.schema(METRIC_LEDGER_SCHEMA).parquet(path)
