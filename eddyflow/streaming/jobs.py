"""Ready-made streaming jobs, one per kind of job the original ran.

Each takes its input as a streaming DataFrame of text (``value``) or records
(``topic, partition, offset, key, value, timestamp``): from Kafka
(``sources.kafka``), a socket (``sources.socket``) or files.  Each returns the
started query; pass ``trigger="available_now"`` to drain what is there and stop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.offsets import starting_offsets_json
from ..operators.rangejoin import RangeTable
from ..operators.ranking import cached_global_position
from ..operators.wordcount import count_order, word_count
from ..sinks.console import preview_writer
from ..sinks.tables import overwrite_partitions
from ..sources.kafka import kafka_options, read_kafka_stream
from .ledger import run_of
from .orders import OrderMetricsBatch, start_order_metrics, stored_offsets
from .runner import with_trigger
from .wordcount import start_running_word_count


def batch_word_count_preview(text: DataFrame, checkpoint: str, trigger: str | None = None,
                             num_rows: int = 10) -> StreamingQuery:
    """Word count of each micro-batch on its own, first rows shown per batch
    (socket and Kafka word counts).  Each batch is counted inside
    ``foreachBatch`` so no state is kept between batches."""
    def show(batch: DataFrame, batch_id: int) -> None:
        word_count(batch, "value").show(num_rows, truncate=False)
    writer = text.writeStream.foreachBatch(show).option("checkpointLocation", checkpoint)
    return with_trigger(writer, trigger).start()


def running_word_count_preview(text: DataFrame, checkpoint: str, trigger: str | None = None,
                               num_rows: int = 10, state_partitions: int | None = None) -> StreamingQuery:
    """Running totals kept in the state store; the words changed by each batch
    are shown (the totals are also available in full via
    ``start_running_word_count`` into a table)."""
    from .runner import session_conf, stateful_settings
    spark = text.sparkSession
    writer = preview_writer(word_count(text, "value"), num_rows, "update").option("checkpointLocation", checkpoint)
    with session_conf(spark, stateful_settings(spark, state_partitions)):
        return with_trigger(writer, trigger).start()


def running_word_count_table(text: DataFrame, out_path: str, checkpoint: str,
                             trigger: str | None = None, state_partitions: int | None = None) -> StreamingQuery:
    return start_running_word_count(text, out_path, checkpoint, "value", trigger, state_partitions)


class SortedBatchCounts:
    """``foreachBatch`` body: this batch's counts in ascending order with their
    position, into the batch's own partition of ``out_path``."""

    def __init__(self, out_path: str):
        self.out_path = out_path

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        with cached_global_position(word_count(batch, "value"), count_order()) as ranked:
            overwrite_partitions(ranked.withColumn("run", F.lit(run_of(batch)))
                                 .withColumn("batch_id", F.lit(batch_id).cast("bigint")),
                                 self.out_path, ["run", "batch_id"])


def sorted_batch_word_count(text: DataFrame, out_path: str, checkpoint: str,
                            trigger: str | None = None) -> StreamingQuery:
    writer = (text.writeStream.foreachBatch(SortedBatchCounts(out_path))
              .option("checkpointLocation", checkpoint))
    return with_trigger(writer, trigger).start()


def order_metrics_job(lines: DataFrame, rules: RangeTable, metric_ledger: str, checkpoint: str,
                      query: str, offset_ledger: str | None = None, group_id: str | None = None,
                      trigger: str | None = None, strict: bool = True,
                      reject_path: str | None = None) -> StreamingQuery:
    """Order metrics into the delta ledger; with ``offset_ledger`` and a
    record stream, the consumed offsets are recorded after the deltas."""
    job = OrderMetricsBatch(rules, metric_ledger, query, offset_ledger, group_id, strict, reject_path)
    return start_order_metrics(lines, job, checkpoint, trigger)


def resume_options(spark: SparkSession, bootstrap_servers: str, topic: str, group_id: str,
                   offset_ledger: str, partitions: int, **extra: str) -> dict[str, str]:
    """Kafka options that resume a group from its stored offsets, or start
    at ``earliest`` when none are stored.  Only the latest row per partition
    (a handful) reaches the driver, to build the option text."""
    rows = stored_offsets(spark, offset_ledger, group_id).where(F.col("topic") == topic).collect()
    start = starting_offsets_json(rows, {topic: partitions})
    return kafka_options(bootstrap_servers, [topic], start, **extra)


def kafka_order_metrics_job(spark: SparkSession, bootstrap_servers: str, topic: str, group_id: str,
                            partitions: int, rules: RangeTable, metric_ledger: str,
                            offset_ledger: str, checkpoint: str,
                            trigger: str | None = None) -> StreamingQuery:
    """The order job resumed from the offset ledger (needs the Kafka connector
    on the classpath).  A checkpoint goes on by itself; a new one starts at the
    stored offsets, and its batches are added to those of the runs before."""
    opts = resume_options(spark, bootstrap_servers, topic, group_id, offset_ledger, partitions)
    records = read_kafka_stream(spark, opts)
    return order_metrics_job(records, rules, metric_ledger, checkpoint, group_id,
                             offset_ledger, group_id, trigger)
