"""Sinks: partition-overwrite tables, JDBC, Kafka, console."""

from .console import full_print_writer, preview_writer, record_lines
from .jdbc import append_offsets_jdbc, write_word_counts_jdbc
from .kafka import kafka_payload, kafka_stream_writer, write_kafka
from .tables import append_table, overwrite_partitions

__all__ = [
    "append_offsets_jdbc", "append_table", "full_print_writer", "kafka_payload",
    "kafka_stream_writer", "overwrite_partitions", "preview_writer", "record_lines",
    "write_kafka", "write_word_counts_jdbc",
]
