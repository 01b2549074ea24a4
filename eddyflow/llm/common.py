"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import shared_path

# Fixed by the contracts: a word is a run of characters outside these.
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row: inside a lambda a
    plain column expression would be computed again for every element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def text_of(col: str = "text") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def split_words(text: Column) -> Column:
    """All words ``[^\\x20\\x09-\\x0D]+`` of ``text``, in order."""
    return F.array_remove(F.split(text, SPACE_CLASS + "+"), "")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: later jobs
    neither recompute it nor depend on any executor still being alive."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, group: list[str], order: list[str], out: str, spread: Column,
             parts: int | None = None) -> DataFrame:
    """``out``: 0, 1, 2 … within each ``group``, without one task per group.

    Rows of a group are dealt by ``spread`` (a 64-bit hash of columns that tell
    rows apart) over ``parts`` sub-groups (as many as shuffle partitions); each sub-group is numbered by its own
    window, and the sub-groups' sizes (groups x parts rows) are added up before
    it.  Rows equal in ``spread`` and ``order`` are interchangeable.
    """
    if parts is None:
        parts = max(64, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = df.withColumn("_sub", F.pmod(spread, F.lit(parts)).cast("int"))
    sizes = dealt.groupBy(*group, "_sub").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*group).orderBy("_sub").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select(*[F.col(c).alias(f"_g_{c}") for c in group], F.col("_sub").alias("_g_sub"),
                         F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    at = Window.partitionBy(*group, "_sub").orderBy(*order)
    ranked = dealt.withColumn("_at", F.row_number().over(at) - 1)
    on = [F.col(c).eqNullSafe(F.col(f"_g_{c}")) for c in group] + [F.col("_sub") == F.col("_g_sub")]
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    return (ranked.join(bases, cond)
            .withColumn(out, (F.col("_base") + F.col("_at")).cast("long"))
            .drop("_sub", "_at", "_base", "_g_sub", *[f"_g_{c}" for c in group]))
