"""DataFrame -> DataFrame operators."""

from .income import (METRIC_CATEGORY, METRIC_PROVINCE, METRIC_TOTAL, TOTAL_INCOME_KEY, income_by,
                     income_by_category, income_by_province, metric_deltas, metrics_one_pass,
                     total_income)
from .metrics import flat_view, running_totals
from .offsets import batch_offsets, latest_offsets, starting_offsets_json, unconsumed
from .rangejoin import RangeRuleError, RangeTable, point_lookup, prepare_ranges, range_lookup
from .ranking import cached_global_position, with_global_position
from .wordcount import sorted_word_count, top_words, word_count, word_count_per_batch, words

__all__ = [
    "METRIC_CATEGORY", "METRIC_PROVINCE", "METRIC_TOTAL", "TOTAL_INCOME_KEY", "RangeRuleError",
    "RangeTable", "batch_offsets", "cached_global_position", "flat_view", "income_by", "income_by_category",
    "income_by_province", "latest_offsets", "metric_deltas", "metrics_one_pass", "point_lookup",
    "prepare_ranges", "range_lookup", "running_totals", "sorted_word_count",
    "starting_offsets_json", "top_words", "total_income", "unconsumed", "with_global_position",
    "word_count", "word_count_per_batch", "words",
]
