"""Console output: the first rows of each batch, or all of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from ..functions.records import format_record

PREVIEW_ROWS = 10  # rows a batch preview shows (the original default)


def preview_writer(df: DataFrame, num_rows: int = PREVIEW_ROWS, output_mode: str = "update") -> DataStreamWriter:
    """First ``num_rows`` rows of every micro-batch on the driver's console;
    only those rows leave the executors."""
    def show(batch: DataFrame, batch_id: int) -> None:
        print(f"batch {batch_id}")
        batch.show(num_rows, truncate=False)
    return df.writeStream.foreachBatch(show).outputMode(output_mode)


def print_rows(rows) -> None:
    """Print the rows of one partition where they are."""
    for row in rows:
        print(*row, sep="\t", flush=True)


def full_print_writer(df: DataFrame, output_mode: str = "complete") -> DataStreamWriter:
    """Every row of every batch, printed by the executors that hold them."""
    def show(batch: DataFrame, batch_id: int) -> None:
        batch.foreachPartition(print_rows)
    return df.writeStream.foreachBatch(show).outputMode(output_mode)


def record_lines(records: DataFrame, with_key: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """Records as printable ``offset = .., key = .., value = ..`` text."""
    key = records["key"] if with_key else None
    return records.select(*keep, format_record(records["offset"], records["value"], key).alias("line"))
