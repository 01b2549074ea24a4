"""Order lines (``buyer ip category item price``) as a text source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.orderline import format_order_line
from .tables import joined_by_broadcast, read_table


def read_order_log(spark: SparkSession, path: str) -> DataFrame:
    """Order lines from text files, one per line, as ``value``."""
    return spark.read.text(path)


def buyer_ip(custkey: Column) -> Column:
    """An IPv4 address per buyer key (fixed rule for the driver's tables):
    ``16 + 7c mod 108 . c mod 256 . (c >> 8) mod 256 . 13c mod 256``."""
    c = custkey.cast("bigint")
    return F.concat_ws(".", ((c * 7) % 108 + 16).cast("string"), (c % 256).cast("string"),
                       (F.shiftright(c, 8) % 256).cast("string"), ((c * 13) % 256).cast("string"))


def order_log_from_tables(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """One order line per lineitem: buyer = customer key, ip from the key,
    category = part type, item = part name with ``_`` for spaces (a space would
    shift the price), price = extended price.  ``keep`` names lineitem columns to
    carry along.

    Two equi-joins on the tables' keys; Spark sizes them at runtime (AQE turns
    the part join into a broadcast only when the measured side is small, and
    splits skewed keys in a shuffled join).  A small lineitem is dealt over the
    cores only where no shuffle of the orders join does so.
    """
    orders = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    lineitem = read_table(spark, sf_dir, "lineitem", *dict.fromkeys(("l_orderkey", "l_partkey", "l_extendedprice", *keep)),
                          spread=joined_by_broadcast(orders))
    part = read_table(spark, sf_dir, "part", "p_partkey", "p_type", "p_name")
    joined = (lineitem
              .join(orders, lineitem["l_orderkey"] == orders["o_orderkey"])
              .join(part, lineitem["l_partkey"] == part["p_partkey"]))
    return joined.select(*keep, format_order_line(
        F.col("o_custkey"), buyer_ip(F.col("o_custkey")), F.col("p_type"),
        F.regexp_replace(F.col("p_name"), " ", "_"), F.col("l_extendedprice")).alias("value"))


def wide_order_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines whose prices cover the range of doubles: category = part size,
    price = extended price times ``2**(40 * (size - 25))``; the prices of sizes 48 to
    50 are infinities of both signs, infinities, and NaN.  Each seventh line of an order
    is followed by a line without a price."""
    lineitem = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice")
    orders = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    part = read_table(spark, sf_dir, "part", "p_partkey", "p_size", "p_name")
    joined = (lineitem.join(orders, lineitem["l_orderkey"] == orders["o_orderkey"])
              .join(part, lineitem["l_partkey"] == part["p_partkey"]))
    size = F.col("p_size")
    moved = F.col("l_extendedprice") * F.pow(F.lit(2.0), ((size - 25) * 40).cast("double"))
    price = (F.when(size == 50, "NaN").when(size == 49, "Infinity")
             .when(size == 48, F.when(F.col("l_partkey") % 2 == F.col("l_orderkey") % 2, "Infinity").otherwise("-Infinity"))
             .otherwise(moved.cast("string")))
    line = F.concat_ws(" ", F.col("o_custkey").cast("string"), buyer_ip(F.col("o_custkey")), size.cast("string"),
                       F.regexp_replace(F.col("p_name"), " ", "_"), price)
    broken = F.when(F.col("l_linenumber") % 7 == 0, F.concat_ws(" ", F.lit("x"), buyer_ip(F.col("o_custkey")), F.lit("7")))
    return joined.select(F.explode(F.array_compact(F.array(line, broken))).alias("value"))
