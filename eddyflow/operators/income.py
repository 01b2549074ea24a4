"""Income metrics of order lines: total, per category, per province.

Prices may be any double.  They are summed exactly (``functions.exactsum``) and the
sum is rounded once: the same whatever the order of addition, and what the
original's additions come to but for their rounding errors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exactsum import UNITS_TYPE, exact_parts, exact_totals, exponent, units

# Fixed key of the grand total in the metric store (value of the original).
TOTAL_INCOME_KEY = "TOTAL_INCOME"

METRIC_TOTAL = "total"
METRIC_CATEGORY = "category"
METRIC_PROVINCE = "province"


def total_income(lines: DataFrame, price: str = "price") -> DataFrame:
    """One row ``total_income`` (null over no lines)."""
    return exact_totals(exact_parts(lines, [], price), [], "total_income")


def income_by(lines: DataFrame, key: str, price: str = "price", out: str = "income") -> DataFrame:
    """``key, income``; partial sums are combined on the map side."""
    parts = exact_parts(lines, [key], price)
    return exact_totals(parts, [key], out)


def income_by_category(lines: DataFrame) -> DataFrame:
    return income_by(lines, "category")


def income_by_province(lines_with_province: DataFrame) -> DataFrame:
    return income_by(lines_with_province, "province")


def metric_deltas(lines_with_province: DataFrame, price: str = "price") -> DataFrame:
    """All three metrics in one pass: ``metric, key, exponent, units``.

    Prices are summed once per (category, province), combined on the map side;
    GROUPING SETS ((), (category), (province)) then adds up those few sums, so
    the rows that it expands do not grow with the input.  ``grouping_id`` names
    the metric.  Over no input it gives no row, so an empty batch adds nothing.
    """
    cells = exact_parts(lines_with_province, ["category", "province"], price)
    sets = [["exponent"], ["category", "exponent"], ["province", "exponent"]]
    agg = (cells.groupingSets(sets, "category", "province", "exponent")
           .agg(F.sum("units").alias("units"), F.grouping("category").alias("_c"), F.grouping("province").alias("_p")))
    metric, key = _metric_and_key()
    return agg.select(metric.alias("metric"), key.alias("key"), "exponent", F.col("units").cast(UNITS_TYPE).alias("units"))


def _metric_and_key() -> tuple[Column, Column]:
    """From the grouping flags ``_c`` and ``_p`` of category and province."""
    is_total, is_category = (F.col("_c") == 1) & (F.col("_p") == 1), F.col("_c") == 0
    metric = (F.when(is_total, F.lit(METRIC_TOTAL)).when(is_category, F.lit(METRIC_CATEGORY))
              .otherwise(F.lit(METRIC_PROVINCE)))
    key = F.when(is_total, F.lit(TOTAL_INCOME_KEY)).when(is_category, F.col("category")).otherwise(F.col("province"))
    return metric, key


def record_deltas(records_with_province: DataFrame, price: str = "price") -> DataFrame:
    """``metric_deltas`` of parsed records and, by the same shuffles, what they consumed:
    ``metric, key, exponent, units, topic, partitioner, offset``.

    Rows with a metric are those of ``metric_deltas``; a row without one holds the
    exclusive end of a topic partition (last offset + 1).  A record without a price
    counts for its partition only.  A task that reads one topic partition, as from
    Kafka, combines to as many cells as without the partition among the keys.
    """
    x = F.col(price).cast("double")
    keys = ["topic", "partition", "category", "province", "exponent"]
    split = records_with_province.select(*keys[:4], "offset", x.alias("_x"), exponent(x).alias("exponent"))
    cells = split.groupBy(*keys).agg(F.sum(units(F.col("_x"), F.col("exponent"))).cast(UNITS_TYPE).alias("units"),
                                     F.max("offset").alias("offset"))
    sets = [["exponent"], ["category", "exponent"], ["province", "exponent"], ["topic", "partition"]]
    agg = cells.groupingSets(sets, *keys).agg(
        F.sum("units").alias("units"), F.max("offset").alias("offset"), F.grouping("category").alias("_c"),
        F.grouping("province").alias("_p"), F.grouping("topic").alias("_t"))
    is_end = F.col("_t") == 0
    metric, key = (F.when(~is_end, c) for c in _metric_and_key())
    return agg.where(is_end | F.col("exponent").isNotNull()).select(
        metric.alias("metric"), key.alias("key"), "exponent", F.col("units").cast(UNITS_TYPE).alias("units"),
        "topic", F.col("partition").cast("int").alias("partitioner"),
        F.when(is_end, F.col("offset") + 1).cast("bigint").alias("offset"))


def metrics_one_pass(lines_with_province: DataFrame) -> DataFrame:
    """``metric, key, income`` (double) for one batch or a bounded table."""
    return exact_totals(metric_deltas(lines_with_province), ["metric", "key"], "income")
