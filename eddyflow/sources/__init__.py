"""Sources: driver tables, rule files, order logs, message records, Kafka,
socket, generators and ledgers."""

from .kafka import as_records, kafka_options, read_kafka_batch, read_kafka_stream, record_values
from .ledger import read_metric_store, read_offset_ledger, read_offset_ledger_jdbc
from .messages import message_stream, messages_for_rows, numbered_messages
from .orderlog import buyer_ip, order_log_from_tables, read_order_log
from .records import records_from_events
from .rules import parse_rule_lines, read_ip_rules, read_ip_rules_with_rejects, rule_lines_from_nations, split_rule_rejects
from .socket import read_socket_stream
from .tables import read_table

__all__ = [
    "as_records", "buyer_ip", "kafka_options", "message_stream", "messages_for_rows",
    "numbered_messages", "order_log_from_tables", "parse_rule_lines", "read_ip_rules",
    "read_kafka_batch", "read_kafka_stream", "read_metric_store", "read_offset_ledger",
    "read_offset_ledger_jdbc", "read_order_log", "read_socket_stream", "read_table",
    "read_ip_rules_with_rejects", "record_values", "records_from_events", "rule_lines_from_nations",
    "split_rule_rejects",
]
