"""Newline-separated text from a TCP socket (not fault tolerant: a restart
loses what was in flight; use it for demos only)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_socket_stream(spark: SparkSession, host: str, port: int) -> DataFrame:
    """``value`` lines; nothing connects until the query starts."""
    return (spark.readStream.format("socket")
            .option("host", host).option("port", str(port)).load())
