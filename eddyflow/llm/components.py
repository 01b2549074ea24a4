"""Connected components of a graph held as a DataFrame of links.

Alternating large-star and small-star steps: every node passes the smallest
neighbour it knows to its larger (then to its smaller) neighbours, until links
form stars around each component's smallest node.  Nodes with many links are
handled by a map-side combined minimum and a join in parts; no group of links is
gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

SALTS = 64  # one bit each of a bigint


def _with_min(pairs: DataFrame) -> DataFrame:
    """``u, v, m``: m is the smallest of u and all its v.  The links of a node are
    dealt over ``SALTS`` groups by their other end; the minimum goes to the groups
    that the node has, so that a node with very many links is joined in parts."""
    salt = F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int")
    used = F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), salt))
    groups = F.filter(F.sequence(F.lit(0), F.lit(SALTS - 1)),
                      lambda i: F.call_function("shiftrightunsigned", F.col("used"), i).bitwiseAND(F.lit(1)) == 1)
    least = (pairs.groupBy("u").agg(F.min("v").alias("m"), used.alias("used"))
             .select(F.col("u").alias("mu"), F.least("m", "u").alias("m"), F.explode(groups).alias("ms")))
    dealt = pairs.withColumn("s", salt)
    return dealt.join(least, (F.col("u") == F.col("mu")) & (F.col("s") == F.col("ms"))).select("u", "v", "m")


def components(links: DataFrame) -> DataFrame:
    """``node, component`` of every node that has a link: the smallest node that
    can be reached.  ``links`` has two columns of one integer type."""
    a, b = links.columns
    stars = written(links.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "links")
    before = None
    while True:
        both = stars.union(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_min(both).where(F.col("v") > F.col("u")).select(
            F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = _with_min(large)
        stars = written(small.select(F.col("v").alias("u"), F.col("m").alias("v"))
                        .union(small.select("u", F.col("m").alias("v")))
                        .where(F.col("u") != F.col("v")).distinct(), "links")
        # Two numbers tell whether the links have changed.
        now = stars.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
