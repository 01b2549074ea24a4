"""Structured Streaming jobs: word counts, order metrics, offset ledgers."""

from .offsets import OffsetLedgerBatch, start_offset_ledger
from .jobs import (SortedBatchCounts, batch_word_count_preview, kafka_order_metrics_job,
                   order_metrics_job, resume_options, running_word_count_preview,
                   running_word_count_table, sorted_batch_word_count)
from .ledger import Ledger, metric_ledger, offset_ledger, run_of, running_ledger
from .orders import (OrderMetricsBatch, flat_totals, lines_with_province, order_totals, start_order_metrics,
                     stored_offsets)
from .runner import BATCH_INTERVAL, run_to_end, session_conf, with_trigger
from .staging import stream_lines, stream_table
from .wordcount import (PerBatchWordCount, per_key_counts, read_per_batch_counts, running_counts,
                        start_per_batch_word_count, start_running_word_count)

__all__ = [
    "Ledger", "SortedBatchCounts", "batch_word_count_preview", "kafka_order_metrics_job",
    "metric_ledger", "offset_ledger", "order_metrics_job", "resume_options", "running_word_count_preview",
    "run_of", "running_ledger", "running_word_count_table", "sorted_batch_word_count",
    "BATCH_INTERVAL", "OffsetLedgerBatch", "OrderMetricsBatch", "PerBatchWordCount",
    "flat_totals", "per_key_counts", "lines_with_province", "order_totals",
    "read_per_batch_counts", "run_to_end", "running_counts", "session_conf",
    "start_offset_ledger", "start_order_metrics",
    "start_per_batch_word_count", "start_running_word_count", "stream_lines", "stream_table", "stored_offsets", "with_trigger",
]
