"""SQL table sinks (the ``access_log(word, count)`` table of the original).

Spark's JDBC writer opens one connection per partition and batches inserts;
``numPartitions`` caps concurrent connections against the database.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_word_counts_jdbc(counts: DataFrame, url: str, table: str = "access_log",
                           properties: dict[str, str] | None = None, max_connections: int = 20,
                           batch_size: int = 1000) -> None:
    props = dict(properties or {})
    props.setdefault("numPartitions", str(max_connections))
    props.setdefault("batchsize", str(batch_size))
    counts.select("word", "cnt").write.mode("append").jdbc(url, table, properties=props)


def append_offsets_jdbc(rows: DataFrame, url: str, table: str = "Offset",
                        properties: dict[str, str] | None = None) -> None:
    """Append ``groupid, topic, partitioner, offset`` ledger rows."""
    rows.select("groupid", "topic", "partitioner", "offset").write.mode("append").jdbc(
        url, table, properties=properties or {})
