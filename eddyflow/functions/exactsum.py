"""Exact, order-free sums of doubles.

A finite double is an integer times a power of two.  ``exponent`` names the power
(a multiple of ``STEP``) and ``units`` the integer, so rows of one exponent add up
as integers: exact, combinable on the map side, the same in any order.  NaN and the
infinities have exponents of their own and are counted there.  A sum is thus a few
rows ``keys, exponent, units``, which can be stored and added to at any time;
``exact_value`` turns them into the double nearest to the true sum, rounded once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STEP = 4
UNITS_TYPE = "decimal(38,0)"
NAN, PLUS_INFINITY, MINUS_INFINITY = 9999, 9998, 9997
_INFINITY = float("inf")
_BITS = 54  # one more than a double's, as the estimated power may be one too high


def _power(x: Column) -> Column:
    """A multiple of STEP, at most that of the last bit of ``x``."""
    top = F.floor(F.log2(F.abs(x))).cast("int") - _BITS
    return top - F.pmod(top, F.lit(STEP))


def exponent(x: Column) -> Column:
    """The exponent class of a double; null for null."""
    return (F.when(F.isnan(x), NAN).when(x == _INFINITY, PLUS_INFINITY).when(x == -_INFINITY, MINUS_INFINITY)
            .when(x == 0, 0).when(x.isNotNull(), _power(x))).cast("int")


def units(x: Column, e: Column) -> Column:
    """``x`` as an integer of its class ``e``: ``x * 2**-e`` in two steps, neither
    of which rounds or overflows; a count of one for NaN and infinities."""
    half = F.shiftright(-e, 1)
    two = F.lit(2.0)
    whole = (x * F.pow(two, half.cast("double"))) * F.pow(two, (-e - half).cast("double"))
    return F.when(e >= MINUS_INFINITY, F.lit(1)).otherwise(whole.cast("bigint")).cast(UNITS_TYPE)


def exact_parts(df: DataFrame, keys: Sequence[str], value: str | Column) -> DataFrame:
    """``keys, exponent, units``: a few rows a key; nulls count nothing.

    Nulls go by a count, once the rows are added up: a null test before would be
    pushed to the scan or into a join with the whole expression that makes ``value``,
    which is then computed many times a row.
    """
    x = (F.col(value) if isinstance(value, str) else value).cast("double")
    split = df.select(*keys, x.alias("_x")).withColumn("exponent", exponent(F.col("_x")))
    added = split.select(*keys, "exponent", units(F.col("_x"), F.col("exponent")).alias("units")).groupBy(
        *keys, "exponent").agg(F.sum("units").cast(UNITS_TYPE).alias("units"), F.count("units").alias("_n"))
    return added.where("_n > 0").drop("_n")


def add_parts(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Parts of equal keys and exponent added up."""
    return parts.groupBy(*keys, "exponent").agg(F.sum("units").cast(UNITS_TYPE).alias("units"))


def exact_value(parts: Column) -> Column:
    """The double nearest to the sum of an array of (exponent, units); null for
    an empty one.  Like addition of doubles it gives NaN if any part is NaN or
    both infinities occur, and an infinity beyond the largest double."""
    return _rounded_sum()(parts)


def _rounded_sum():
    @F.udf("double", useArrow=True)
    def rounded(parts):
        if not parts:
            return None
        special = {p["exponent"] for p in parts if p["exponent"] >= 9997}
        if 9999 in special or {9998, 9997} <= special:
            return float("nan")
        if special:
            return float("inf") if 9998 in special else float("-inf")
        low = min(min(p["exponent"] for p in parts), 0)
        total = sum(int(p["units"]) << (p["exponent"] - low) for p in parts)
        try:
            return total / (1 << -low)  # division of integers rounds once
        except OverflowError:
            return float("inf") if total > 0 else float("-inf")
    return rounded


def exact_totals(parts: DataFrame, keys: Sequence[str], out: str) -> DataFrame:
    """``keys, out``: the parts of each key, added up before (one row an exponent, a
    few hundred at most), put together; without keys one row, null over no parts."""
    held = parts.groupBy(*keys).agg(F.collect_list(F.struct("exponent", "units")).alias("_parts"))
    return held.select(*keys, exact_value(F.col("_parts")).alias(out))
