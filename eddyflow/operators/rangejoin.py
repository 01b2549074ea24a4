"""Range lookup: attach the rule whose [start, end] holds a point.

Spark plans a BETWEEN join as a nested loop (points x rules).  Two plans avoid it.

**Buckets**, for rules that cover few of them: both sides get an equi key, the
point's high bits ``point >> k`` and, for each rule, every value of ``start >> k ..
end >> k``.  The BETWEEN test stays inside the join condition, so a left join keeps
points that match no rule.  Spark chooses between a broadcast and a shuffled join
by the bucket table's size in bytes, and AQE splits a hot bucket of the latter.

**Sweep**, for rules of any width: the number line is cut into cells at quantiles
of the rules' starts and of the points; a rule lies in the cells from its start's
to its end's (rules do not overlap, so all rules together have at most one more
copy per cell).  A cell that many points share is dealt over several sub-cells,
each with the cell's rules.  In a cell, starts and points stand in one order and
the last rule is carried along; a point takes it if it ends at or after the point.

With rules that do not overlap a point matches at most one rule; this is checked,
by a sweep over the rules, when they are prepared.
"""

from __future__ import annotations

from bisect import bisect
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_BUCKET_BITS = 16
MAX_BUCKETS = 1 << 22  # rules that cover more buckets are swept
CELLS = 1024
SMALL_BYTES = 16 << 20  # rules planned to be smaller are checked in one cell
MAX_SUB_CELLS = 256
# A point that no rule can hold stands for null.  It keeps the point's column
# non-null: a null test on it would be pushed to the scan with the whole
# expression that makes the point.
NO_POINT = -(2**63)


class RangeRuleError(ValueError):
    """Rules that are inverted, overlap or have no bounds."""


@dataclass(frozen=True)
class RangeTable:
    """Checked rules, reused per batch: exploded to buckets, or as they are for a
    sweep (``bucket_bits`` null)."""

    buckets: DataFrame          # _bucket (not for a sweep), _start, _end, payload...
    payload: tuple[str, ...]
    bucket_bits: int | None

    def release(self) -> None:
        """Drop the cached table (``prepare_ranges(persist=True)``)."""
        self.buckets.unpersist()


def _cell(cuts: list[float], value: Column) -> Column:
    """The number of ``cuts`` at or below ``value``, by halving: about ten
    comparisons.  Any function that never falls will do for cells, so positions
    are compared as doubles."""
    x, held = value.cast("double"), F.lit(cuts)
    at, step = F.lit(0), 1
    while step * 2 <= len(cuts):
        step *= 2
    while step:
        at = let_column(at, lambda a, s=step: F.when(
            F.coalesce(F.get(held, a + (s - 1)) <= x, F.lit(False)), a + s).otherwise(a))
        step //= 2
    return at


def let_column(value: Column, body) -> Column:
    """``body(value)``, with ``value`` computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _quantiles(df: DataFrame, position: str, n: int) -> list[float]:
    """``n`` ascending quantiles of ``position`` (none over no rows)."""
    return df.select(F.col(position).cast("double").alias("p")).approxQuantile(
        "p", [(i + 1) / (n + 1) for i in range(n)], 0.25 / n)


def _in_cells(rules: DataFrame, cuts: list[float]) -> DataFrame:
    """Each rule in the cells that it reaches."""
    lo, hi = _cell(cuts, F.col("_start")), _cell(cuts, F.greatest("_start", "_end"))
    return rules.withColumn("_cell", F.explode(F.sequence(lo, hi)))


def _check(rules: DataFrame, start: str, end: str, bits: int) -> int:
    """The number of buckets the rules cover; fails on bad rules.  Two rules
    overlap only if they share a cell, where each is compared with the largest
    end of those before it.  Few rules are one cell, and the check one job."""
    ends = rules.select(F.col(start).cast("bigint").alias("_start"), F.col(end).cast("bigint").alias("_end"))
    count = lambda bad: F.count(F.when(bad, 1))
    width = (F.shiftright("_end", bits).cast("decimal(38,0)") - F.shiftright("_start", bits) + 1)
    earlier = F.max("_end").over(
        Window.partitionBy("_cell").orderBy("_start", "_end").rowsBetween(Window.unboundedPreceding, -1))
    small = int(ends._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) <= SMALL_BYTES
    first = ends.withColumn("_cell", F.lit(0)).withColumn("_prev_end", earlier) if small else ends.withColumn(
        "_prev_end", F.lit(None).cast("bigint"))
    overlaps = count(F.col("_prev_end") >= F.col("_start")) if small else F.lit(None).cast("bigint")
    found = first.agg(
        overlaps.alias("overlaps"),
        count(F.col("_start").isNull() | F.col("_end").isNull() | (F.col("_start") <= NO_POINT)).alias("unbounded"),
        count(F.col("_start") > F.col("_end")).alias("inverted"), F.sum(width).alias("buckets")).first()
    if found["unbounded"]:
        raise RangeRuleError(f"{found['unbounded']} rules have no bounds")
    if found["inverted"]:
        raise RangeRuleError(f"{found['inverted']} rules have start > end")
    if found["overlaps"] is None:
        before = _in_cells(ends, sorted(set(_quantiles(ends, "_start", CELLS)))).withColumn("_prev_end", earlier)
        overlaps = before.where(F.col("_prev_end") >= F.col("_start")).select("_start", "_end").distinct().count()
    else:
        overlaps = found["overlaps"]
    if overlaps:
        raise RangeRuleError(f"{overlaps} rules overlap an earlier rule")
    return int(found["buckets"] or 0)


def prepare_ranges(rules: DataFrame, start: str = "start_num", end: str = "end_num",
                   payload: tuple[str, ...] = ("province",), bucket_bits: int = DEFAULT_BUCKET_BITS,
                   persist: bool = False, max_buckets: int = MAX_BUCKETS) -> RangeTable:
    """Check ``rules`` (inverted, overlapping and unbounded ones are errors) and
    explode them to buckets, or keep them for a sweep if they cover more than
    ``max_buckets``.

    ``persist`` keeps the table cached, for streams that use it every
    micro-batch; it is recomputed from the rule source if an executor holding
    it is lost.
    """
    k = bucket_bits
    if _check(rules, start, end, k) > max_buckets:
        kept = rules.select(F.col(start).cast("bigint").alias("_start"), F.col(end).cast("bigint").alias("_end"), *payload)
        return RangeTable(kept.persist() if persist else kept, tuple(payload), None)
    buckets = rules.select(
        F.explode(F.sequence(F.shiftright(F.col(start), k), F.shiftright(F.col(end), k))).alias("_bucket"),
        F.col(start).alias("_start"), F.col(end).alias("_end"), *payload)
    return RangeTable(buckets.persist() if persist else buckets, tuple(payload), k)


def range_lookup(df: DataFrame, point: Column, table: RangeTable, how: str = "left") -> DataFrame:
    """``df`` plus the payload columns of the rule holding ``point``.

    ``how="left"`` keeps unmatched rows with null payload; ``"inner"`` keeps
    only matched rows.  A null point matches nothing.
    """
    if table.bucket_bits is None:
        return _sweep(df, point, table, how)
    probe = (df.withColumn("_point", F.coalesce(point, F.lit(NO_POINT).cast("bigint")))
             .withColumn("_pbucket", F.shiftright(F.col("_point"), table.bucket_bits)))
    rules = table.buckets
    cond = ((probe["_pbucket"] == rules["_bucket"])
            & (probe["_point"] >= rules["_start"]) & (probe["_point"] <= rules["_end"]))
    return (probe.join(rules, cond, how)
            .drop("_point", "_pbucket", "_bucket", "_start", "_end"))


def _sweep(df: DataFrame, point: Column, table: RangeTable, how: str) -> DataFrame:
    """One shuffle of points and rules by cell; the last rule is carried along the
    order of each cell."""
    rules = table.buckets
    points = df.withColumn("_point", point.cast("bigint"))
    known = points.where("_point is not null")
    dealt = _quantiles(known, "_point", CELLS // 2)
    cuts = sorted({*_quantiles(rules, "_start", CELLS // 2), *dealt})
    # Quantiles that fall together mark positions with many points: their cells are dealt over sub-cells.
    at = [bisect(cuts, q) for q in dealt]
    subs = [min(MAX_SUB_CELLS, max(1, n // 2)) for n in (at.count(c) for c in range(len(cuts) + 1))]
    parts = F.get(F.lit(subs), F.col("_cell"))
    keep = [c for c in points.columns if c != "_point"]
    row = F.struct(*keep) if keep else F.lit(None).cast("struct<_none:int>")
    rule = F.struct("_end", *table.payload)
    put = known.withColumn("_cell", _cell(cuts, F.col("_point"))).select(
        "_cell", F.pmod(F.monotonically_increasing_id(), parts).cast("int").alias("_sub"),
        F.col("_point").alias("_at"), F.lit(1).alias("_kind"), row.alias("_row"), F.lit(None).cast(
            rules.select(rule.alias("r")).schema["r"].dataType).alias("_rule"))
    starts = _in_cells(rules, cuts).withColumn("_sub", F.explode(F.sequence(F.lit(0), parts - 1))).select(
        "_cell", "_sub", F.col("_start").alias("_at"), F.lit(0).alias("_kind"),
        F.lit(None).cast(put.schema["_row"].dataType).alias("_row"), rule.alias("_rule"))
    carried = F.last("_rule", ignorenulls=True).over(
        Window.partitionBy("_cell", "_sub").orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, 0))
    met = put.unionByName(starts).withColumn("_rule", carried).where("_kind = 1")
    holds = F.col("_rule._end") >= F.col("_at")
    met = met if how == "left" else met.where(holds)
    found = met.select("_row.*", *[F.when(holds, F.col(f"_rule.{c}")).alias(c) for c in table.payload])
    if how != "left":
        return found
    lost = points.where("_point is null").select(
        *keep, *[F.lit(None).cast(rules.schema[c].dataType).alias(c) for c in table.payload])
    return found.unionByName(lost)


def point_lookup(rules: DataFrame, point: int, start: str = "start_num", end: str = "end_num") -> DataFrame:
    """Rules holding one point (at most one row for checked rules)."""
    return rules.where((F.lit(point).cast("bigint") >= F.col(start)) & (F.lit(point).cast("bigint") <= F.col(end)))
