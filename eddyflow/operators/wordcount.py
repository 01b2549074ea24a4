"""Word counts: bounded, per batch, sorted and top-k.

All counting is ``groupBy(word).count`` so Spark combines on the map side
before the shuffle; a hot word costs one row per task, not one per use.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import java_split_words
from .ranking import with_global_position


def words(df: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per word (Java ``split(" ")`` rules), carrying ``keep`` columns."""
    return df.select(*keep, F.explode(java_split_words(F.col(text_col))).alias("word"))


def word_count(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``word, cnt`` over every text of ``df``."""
    return (words(df, text_col)
            .groupBy("word")
            .agg(F.count(F.lit(1)).alias("cnt")))


def word_count_per_batch(df: DataFrame, batch: str | Column, text_col: str = "text",
                         batch_name: str = "batch_id") -> DataFrame:
    """``batch_id, word, cnt``: each batch counted on its own, no memory across."""
    b = F.col(batch) if isinstance(batch, str) else batch
    return (df.select(b.alias(batch_name), F.col(text_col))
            .transform(lambda d: words(d, text_col, keep=(batch_name,)))
            .groupBy(batch_name, "word")
            .agg(F.count(F.lit(1)).alias("cnt")))


def top_words(counts: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` most frequent words, ties by word; planned as a per-partition
    top-k merged once (TakeOrderedAndProject), never a full sort."""
    return counts.orderBy(F.col("cnt").desc(), F.col("word").asc()).limit(n)


def count_order() -> list[Column]:
    """Ascending count, ties by word: a total order on a count table."""
    return [F.col("cnt").asc(), F.col("word").asc()]


def sorted_word_count(counts: DataFrame, position_col: str = "position") -> DataFrame:
    """Counts ascending (ties by word) with a 1-based ``position``.

    The sort is a range-partitioned global sort; the position is assigned
    without a single-partition window (see ``with_global_position``).
    """
    return with_global_position(counts, count_order(), position_col)
