"""Consumer offsets: what a batch consumed, the latest per partition, resume.

The ledger row of a topic partition holds the exclusive end of what was
consumed (last offset + 1).  Latest is the max per partition, never "the last
row read", so it does not depend on the order the store returns rows in.
"""

from __future__ import annotations

from collections.abc import Iterable

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEDGER_COLUMNS = ("groupid", "topic", "partitioner", "offset")


def batch_offsets(records: DataFrame, group_id: str) -> DataFrame:
    """Ledger rows for the records of one batch: exclusive end per partition."""
    return (records.groupBy("topic", "partition")
            .agg((F.max("offset") + 1).alias("offset"))
            .select(F.lit(group_id).alias("groupid"), "topic",
                    F.col("partition").cast("int").alias("partitioner"),
                    F.col("offset").cast("bigint").alias("offset")))


def latest_offsets(ledger: DataFrame, group_id: str | None = None,
                   topics: Iterable[str] | None = None) -> DataFrame:
    """``groupid, topic, partitioner, offset``: the furthest end per partition.

    The group and topic predicates are plain column filters, pushed into the
    ledger scan (Parquet or JDBC).
    """
    if group_id is not None:
        ledger = ledger.where(F.col("groupid") == group_id)
    if topics is not None:
        ledger = ledger.where(F.col("topic").isin(list(topics)))
    return (ledger.groupBy("groupid", "topic", "partitioner")
            .agg(F.max("offset").alias("offset")))


def unconsumed(records: DataFrame, latest: DataFrame) -> DataFrame:
    """Records at or after the stored end of their partition; partitions with
    no ledger row start from the beginning.  Spark picks the join by the ledger's
    measured size."""
    stored = latest.select(F.col("topic").alias("_t"), F.col("partitioner").alias("_p"),
                           F.col("offset").alias("_stored"))
    cond = (F.col("topic") == F.col("_t")) & (F.col("partition") == F.col("_p"))
    return (records.join(stored, cond, "left")
            .where(F.col("offset") >= F.coalesce(F.col("_stored"), F.lit(0)))
            .drop("_t", "_p", "_stored"))


def starting_offsets_json(latest_rows: Iterable, partition_counts: dict[str, int]) -> str:
    """Kafka ``startingOffsets`` for a resume from stored offsets.

    ``latest_rows`` are the (few) rows of ``latest_offsets``; ``partition_counts``
    maps each subscribed topic to its partition count, because the Kafka source
    needs every partition named: a partition with no stored end starts at -2
    (earliest).  With nothing stored at all the answer is ``earliest``.
    """
    stored = {(r["topic"], int(r["partitioner"])): int(r["offset"]) for r in latest_rows}
    if not any(t in partition_counts for t, _ in stored):
        return "earliest"
    spec = {t: {str(p): stored.get((t, p), -2) for p in range(n)}
            for t, n in sorted(partition_counts.items())}
    return json.dumps(spec, sort_keys=True)
