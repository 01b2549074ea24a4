"""Parquet table sinks keyed by batch, so a retried batch overwrites itself."""

from __future__ import annotations

from pyspark.sql import DataFrame


def overwrite_partitions(df: DataFrame, path: str, partition_cols: list[str]) -> None:
    """Write ``df`` replacing only the partitions it holds rows for.

    Dynamic partition overwrite: a retry of batch N rewrites batch N and leaves
    every other batch alone; an empty ``df`` touches nothing.
    """
    (df.write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_cols)
     .parquet(path))


def append_table(df: DataFrame, path: str, partition_cols: list[str] | None = None) -> None:
    w = df.write.mode("append")
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.parquet(path)
