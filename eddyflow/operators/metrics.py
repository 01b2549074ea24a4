"""Views over the metric ledger (running totals kept outside the stream).

The ledger holds what each batch added as the parts of exact sums (``metric, key,
exponent, units``); a batch writes its own partition, so a retried batch replaces
its rows instead of adding again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.exactsum import add_parts, exact_totals


def running_totals(ledger: DataFrame) -> DataFrame:
    """``metric, key, income``: the sum of every batch's parts."""
    return exact_totals(add_parts(ledger, ["metric", "key"]), ["metric", "key"], "income")


def flat_view(ledger: DataFrame) -> DataFrame:
    """``key, value``: one flat key space, as the original store had.  A
    category and a province of the same name add up under one key."""
    return exact_totals(add_parts(ledger, ["key"]), ["key"], "value")
