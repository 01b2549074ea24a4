"""Order metrics per micro-batch into ledgers.

Per batch, in this order: parse the lines, look up provinces, compute all three
metrics and the offsets in one aggregate, write this batch's deltas, then this
batch's offsets.  One job reads the batch and nothing is cached: the offsets (a row
a topic partition) are observed while the deltas are written.
With an offset ledger the offsets are the commit: totals count only the batches
of a run up to its last one with offsets, so a batch whose offsets were never
written, and which a resume from the offsets will read again, counts once.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.ip import ip_parts_to_number
from ..functions.text import java_split
from ..functions.orderline import parse_order_lines, split_rejects
from ..operators.income import metric_deltas, record_deltas
from ..operators.metrics import flat_view, running_totals
from ..operators.offsets import latest_offsets
from ..operators.rangejoin import RangeTable, range_lookup
from ..sinks.tables import overwrite_partitions
from .ledger import FOLD_EVERY, fold_now_and_then, metric_ledger as metrics_at, offset_ledger as offsets_at, run_of
from .runner import with_trigger

RECORD_COLUMNS = ("topic", "partition", "offset")
END_SCHEMA = "topic string, partitioner int, offset bigint"


def lines_with_province(lines: DataFrame, rules: RangeTable) -> DataFrame:
    """Parsed lines plus ``province`` ('' when no rule holds the IP: the line
    is kept and counted under the empty key)."""
    split = lines.withColumn("_ip_parts", java_split(F.col("ip"), "."))
    zoned = range_lookup(split, ip_parts_to_number(F.col("_ip_parts")), rules, how="left").drop("_ip_parts")
    return zoned.withColumn("province", F.coalesce(F.col("province"), F.lit("")))


def _consumed_only(lines: DataFrame) -> DataFrame:
    """Malformed lines without price and address: they count as consumed alone."""
    good = ~F.col("malformed")
    return lines.withColumns({c: F.when(good, F.col(c)) for c in ("ip", "price")}).drop("malformed")


class OrderMetricsBatch:
    """``foreachBatch`` body for the order metrics job."""

    def __init__(self, rules: RangeTable, metric_ledger: str, query: str,
                 offset_ledger: str | None = None, group_id: str | None = None,
                 strict: bool = True, reject_path: str | None = None, fold_every: int = FOLD_EVERY):
        self.rules = rules
        self.metrics = metrics_at(metric_ledger)
        self.offsets = offsets_at(offset_ledger) if offset_ledger else None
        self.query = query
        self.group_id = group_id or query
        self.strict = strict
        self.reject_path = reject_path
        self.fold_every = fold_every

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        run, spark = run_of(batch), batch.sparkSession
        track = self.offsets is not None and set(RECORD_COLUMNS) <= set(batch.columns)
        lines = parse_order_lines(batch, "value", strict=self.strict, keep=RECORD_COLUMNS if track else ())
        if not self.strict:
            if self.reject_path:  # the rejects are a second, narrow read of the batch
                _, rejects = split_rejects(lines.drop(*RECORD_COLUMNS))
                overwrite_partitions(
                    rejects.withColumn("query", F.lit(self.query)).withColumn("run", F.lit(run))
                    .withColumn("batch_id", F.lit(batch_id).cast("bigint")),
                    self.reject_path, ["query", "run", "batch_id"])
            lines = _consumed_only(lines) if track else split_rejects(lines)[0]
        zoned = lines_with_province(lines, self.rules)
        if track:
            self._write_both(record_deltas(zoned), spark, run, batch_id)
        else:
            self.metrics.write(metric_deltas(zoned), self.query, run, batch_id)
        # The batches before this one are finished: Spark runs them in order.
        fold_now_and_then([self.metrics], spark, self.query, run, batch_id, self.fold_every)
        if track:
            fold_now_and_then([self.offsets], spark, self.group_id, run, batch_id, self.fold_every)

    def _write_both(self, rows: DataFrame, spark: SparkSession, run: str, batch_id: int) -> None:
        """Deltas by one job, then the offsets that it has seen on the way."""
        seen = Observation()
        end = F.to_json(F.struct("topic", "partitioner", "offset"))
        rows = rows.observe(seen, F.collect_set(F.when(F.col("metric").isNull(), end)).alias("ends"))
        self.metrics.write(rows.where("metric is not null"), self.query, run, batch_id)
        ends = [json.loads(e) for e in seen.get["ends"]]
        if ends:
            self.offsets.write(spark.createDataFrame(ends, END_SCHEMA).coalesce(1), self.group_id, run, batch_id)


def start_order_metrics(stream: DataFrame, job: OrderMetricsBatch, checkpoint: str,
                        trigger: str | None = None) -> StreamingQuery:
    writer = (stream.writeStream.foreachBatch(job)
              .option("checkpointLocation", checkpoint).queryName(job.query))
    return with_trigger(writer, trigger).start()


def order_totals(spark: SparkSession, metric_ledger: str, query: str | None = None,
                 offset_ledger: str | None = None, group_id: str | None = None,
                 wanted: Column | None = None) -> DataFrame:
    """``metric, key, income`` accumulated over every batch written so far; with
    the job's offset ledger, over every batch whose offsets are stored.  ``wanted``,
    a predicate on ``metric`` and ``key``, reads only those totals."""
    committed = None
    if offset_ledger:
        committed = offsets_at(offset_ledger).positions(spark, group_id or query)
    deltas = metrics_at(metric_ledger).read(spark, query, committed)
    return running_totals(deltas if wanted is None else deltas.where(wanted))


def flat_totals(spark: SparkSession, metric_ledger: str, wanted: Column | None = None) -> DataFrame:
    """``key, value`` in one flat key space over every query's deltas; with
    ``wanted``, a predicate on ``key``, of those keys alone."""
    deltas = metrics_at(metric_ledger).read(spark)
    return flat_view(deltas if wanted is None else deltas.where(wanted))


def stored_offsets(spark: SparkSession, offset_ledger: str, group_id: str) -> DataFrame:
    return latest_offsets(offsets_at(offset_ledger).read(spark, group_id), group_id)
