"""The driver's Parquet tables, read with only the columns a job needs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import default_parallelism


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str,
               spread: bool = False) -> DataFrame:
    """``<sf_dir>/<name>.parquet``; naming ``columns`` makes the projection
    explicit (Catalyst would prune anyway, this keeps the plan obvious).

    ``spread`` is for tables with heavy per-row work: see ``spread_small``.
    """
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    df = df.select(*columns) if columns else df
    return spread_small(df) if spread else df


def spread_small(df: DataFrame) -> DataFrame:
    """Deal the rows of a table that cannot fill the cluster's cores by itself
    (less than a full scan split a core, as planned: no job is run) over them,
    row by row.  Larger tables are returned as they are, with no shuffle."""
    spark = df.sparkSession
    cores = default_parallelism(spark)
    split = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    return df.repartition(cores) if planned_bytes(df) < cores * split else df


def joined_by_broadcast(df: DataFrame) -> bool:
    """Whether a join is planned to broadcast ``df``; else it shuffles, and deals the
    rows of both sides by itself."""
    return planned_bytes(df) <= df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def planned_bytes(df: DataFrame) -> int:
    """The size of ``df`` as Spark plans with it: no job is run."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
