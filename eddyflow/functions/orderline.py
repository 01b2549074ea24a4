"""The space-separated order line: ``buyer ip category item price``.

Positions follow the original jobs: 1 is the IP, 2 the category, 4 the price;
0 (buyer) and 3 (item) are carried along but never used in a metric.  Extra
fields are ignored.  A line with fewer than five fields, a price that is not a
number or an address that is not one fails the batch in strict mode (the
original fails too); permissive mode marks such lines so they can be routed to a
reject table instead of being dropped silently.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ip import is_ip_text
from .text import java_split

ORDER_FIELDS = ("buyer", "ip", "category", "item", "price")


def format_order_line(buyer: Column, ip: Column, category: Column, item: Column,
                      price: Column) -> Column:
    """One order line; the price is written with Spark's double-to-text cast,
    which reads back to the same double."""
    return F.concat_ws(" ", buyer.cast("string"), ip, category, item,
                       price.cast("double").cast("string"))


def _bad_line(value: Column, parts: Column, price: Column) -> Column:
    return value.isNull() | (F.size(parts) < 5) | price.isNull()


def parse_order_lines(df: DataFrame, value_col: str = "value", strict: bool = True,
                      keep: tuple[str, ...] = ()) -> DataFrame:
    """Split ``value_col`` into the five named fields (price as double).

    ``keep`` names input columns to carry along (e.g. Kafka offsets).  In
    permissive mode a boolean column ``malformed`` is added.  The line is
    split once, in its own projection, and the fields are taken from it.
    """
    split = df.select(*[F.col(c) for c in keep], F.col(value_col).alias("_line"),
                      java_split(F.col(value_col), " ").alias("_parts"))
    value, parts = F.col("_line"), F.col("_parts")
    price = F.get(parts, 4).try_cast("double")
    bad = _bad_line(value, parts, price)
    if strict:
        guard = F.when(bad, F.raise_error(
            F.concat(F.lit("malformed order line: "), F.coalesce(value, F.lit("<null>")))))
        price = F.coalesce(guard.cast("double"), price)
    cols = [F.col(c) for c in keep] + [
        F.get(parts, 0).alias("buyer"),
        F.get(parts, 1).alias("ip"),
        F.get(parts, 2).alias("category"),
        F.get(parts, 3).alias("item"),
        price.alias("price"),
    ]
    if not strict:
        cols.append((bad | ~is_ip_text(F.get(parts, 1))).alias("malformed"))
    return split.select(*cols)


def split_rejects(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Permissive mode: (good lines, rejected lines)."""
    return (parsed.where(~F.col("malformed")).drop("malformed"),
            parsed.where(F.col("malformed")).drop("malformed"))
