"""Message-record formatting (the console consumers of the original)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed output formats of the record printers, kept verbatim.
RECORD_FORMAT_WITH_KEY = "offset = %d, key = %s, value = %s"
RECORD_FORMAT_NO_KEY = "offset = %d, value = %s"


def format_record(offset: Column, value: Column, key: Column | None = None) -> Column:
    """Text of one record; a null key prints as ``null`` like Java's printf."""
    if key is None:
        return F.format_string(RECORD_FORMAT_NO_KEY, offset, value)
    return F.format_string(RECORD_FORMAT_WITH_KEY, offset, key, value)


def numbered_message(prefix: str, n: Column, suffix: str = "") -> Column:
    """``prefix + n + suffix`` (e.g. ``this is message`` + 1000)."""
    parts = [F.lit(prefix), n.cast("string")]
    if suffix:
        parts.append(F.lit(suffix))
    return F.concat(*parts)
