"""Global 1-based position in a sorted order, without a one-partition window."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_path


def with_global_position(df: DataFrame, order: list[Column], position_col: str = "position") -> DataFrame:
    """Sort ``df`` by ``order`` and number the rows 1..n.

    ``row_number()`` over an unpartitioned window pulls every row into one task.
    Instead: range-partition sort, write each row once with its partition and its
    place there (to the shared folder), count rows per partition (one row per
    partition), and turn the counts into start offsets.  The offsets table has
    one row per partition, so broadcasting it is bounded by the partition count.
    """
    spark = df.sparkSession
    path = shared_path(spark, "sorted")
    tagged = _tag(df.orderBy(*order))
    tagged.write.parquet(path)
    return _number(spark.read.schema(tagged.schema).parquet(path), position_col)


@contextlib.contextmanager
def cached_global_position(df: DataFrame, order: list[Column],
                           position_col: str = "position") -> Iterator[DataFrame]:
    """As ``with_global_position`` with the sorted partitions cached instead
    of written, released on exit: for per-batch use in a stream, where files
    would pile up.  A lost cached block is recomputed through the same
    range-partitioned shuffle; with a total order on unique keys it comes back
    identical."""
    ordered = _tag(df.orderBy(*order)).persist()
    try:
        ordered.count()
        yield _number(ordered, position_col)
    finally:
        ordered.unpersist()


def _tag(ordered: DataFrame) -> DataFrame:
    return (ordered.withColumn("_pid", F.spark_partition_id())
            .withColumn("_mid", F.monotonically_increasing_id()))


def _number(tagged: DataFrame, position_col: str) -> DataFrame:
    sizes = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return (tagged.join(F.broadcast(starts), "_pid")
            .withColumn(position_col,
                        F.col("_start") + (F.col("_mid") - F.shiftleft(F.col("_pid").cast("bigint"), 33)) + 1)
            .drop("_pid", "_mid", "_start"))
