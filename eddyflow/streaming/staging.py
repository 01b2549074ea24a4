"""Tables as stream input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import shared_path
from ..storage import size_of

# A micro-batch takes about this much of the input, and a quarter of it at most:
# a stream over a bounded table is always several batches.
BATCH_BYTES = 16 << 30
MIN_BATCHES = 4


def batch_bytes(total: int, limit: int = BATCH_BYTES) -> int:
    return max(1, min(limit, total // MIN_BATCHES))


def stream_table(spark: SparkSession, sf_dir: str, name: str, limit: int = BATCH_BYTES) -> DataFrame:
    """The Parquet table ``name`` as a file stream, read where it lies.  The file
    source hands out whole files: a table of fewer files than batches is dealt
    over that many first."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    table = spark.read.parquet(path)
    if size_of(spark, path)[0] < MIN_BATCHES:
        path = shared_path(spark, f"staged-{name}")
        table.repartition(MIN_BATCHES).write.parquet(path)
    return stream_folder(spark, path, table.schema, limit)


def stream_folder(spark: SparkSession, path: str, schema, limit: int = BATCH_BYTES) -> DataFrame:
    """A folder of Parquet files as a file stream."""
    return spark.readStream.schema(schema).option(
        "maxBytesPerTrigger", batch_bytes(size_of(spark, path)[1], limit)).parquet(path)


def stream_lines(spark: SparkSession, df: DataFrame, path: str, limit: int = BATCH_BYTES) -> DataFrame:
    """Write the one text column of ``df`` under ``path``, once, and stream it;
    lines in fewer files than batches are dealt over that many."""
    df.write.text(path)
    files, total = size_of(spark, path)
    if files <= MIN_BATCHES:  # one of them is the mark of success
        spark.read.text(path).repartition(MIN_BATCHES).write.text(f"{path}-dealt")
        path = f"{path}-dealt"
    return spark.readStream.option("maxBytesPerTrigger", batch_bytes(total, limit)).text(path)
