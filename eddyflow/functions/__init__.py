"""Column-level building blocks (all JVM-side built-in expressions)."""

from .ip import ip_parts_to_number, ip_to_number, number_to_ip
from .orderline import ORDER_FIELDS, format_order_line, parse_order_lines, split_rejects
from .records import format_record, numbered_message
from .text import java_split, java_split_words

__all__ = [
    "ORDER_FIELDS", "format_order_line", "format_record", "ip_parts_to_number", "ip_to_number", "java_split", "java_split_words",
    "number_to_ip", "numbered_message", "parse_order_lines", "split_rejects",
]
