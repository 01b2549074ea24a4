"""Streaming word counts: per micro-batch, and running over all batches.

Both write through ``foreachBatch`` into a ledger (see ``ledger``): when Spark
runs a batch again after a failure its rows are replaced, not added twice, and
a new checkpoint writes beside the runs before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.wordcount import word_count, words
from .ledger import FOLD_EVERY, fold_now_and_then, per_batch_ledger, run_of, running_ledger
from .runner import session_conf, stateful_settings, with_trigger

JOB = "words"


class PerBatchWordCount:
    """``foreachBatch`` body: count the words of this batch alone.

    With ``keys`` (columns of the input, e.g. the arrival batch a record
    belongs to), the words are counted per key inside the micro-batch; rows
    of one key that arrive over several micro-batches are added up by
    ``per_key_counts``, so the result does not depend on how the source cut
    the micro-batches.  Such partial counts are folded; counts of batches that
    stand alone are a result each and stay as they are.
    """

    def __init__(self, out_path: str, text_col: str = "value", keys: tuple[str, ...] = (),
                 fold_every: int = FOLD_EVERY):
        self.out_path = out_path
        self.text_col = text_col
        self.keys = tuple(keys)
        self.fold_every = fold_every if keys else 0

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        run = run_of(batch)
        kinds = dict(batch.dtypes)
        ledger = per_batch_ledger(self.out_path, tuple((k, kinds[k]) for k in self.keys))
        counts = (words(batch, self.text_col, keep=self.keys)
                  .groupBy(*self.keys, "word").agg(F.count(F.lit(1)).alias("cnt")))
        ledger.write(counts, JOB, run, batch_id)
        fold_now_and_then([ledger], batch.sparkSession, JOB, run, batch_id, self.fold_every)


def start_per_batch_word_count(stream: DataFrame, out_path: str, checkpoint: str,
                               text_col: str = "value", trigger: str | None = None,
                               name: str | None = None, keys: tuple[str, ...] = (),
                               fold_every: int = FOLD_EVERY) -> StreamingQuery:
    writer = (stream.writeStream.foreachBatch(PerBatchWordCount(out_path, text_col, keys, fold_every))
              .option("checkpointLocation", checkpoint))
    if name:
        writer = writer.queryName(name)
    return with_trigger(writer, trigger).start()


def read_per_batch_counts(spark: SparkSession, out_path: str) -> DataFrame:
    """``run, batch_id, word, cnt`` of a job started without keys."""
    return per_batch_ledger(out_path).read(spark, JOB).select("run", "batch_id", "word", "cnt")


def per_key_counts(spark: SparkSession, out_path: str, keys: str) -> DataFrame:
    """``<keys>, word, cnt`` of a keyed job: micro-batch partials added up
    (a combinable sum).  ``keys`` is a DDL list such as ``"turn bigint"``."""
    typed = tuple((k.split()[0], k.split()[1]) for k in keys.split(","))
    ledger = per_batch_ledger(out_path, typed)
    return ledger.folded(ledger.read(spark, JOB))


class _WriteChanged:
    def __init__(self, out_path: str, fold_every: int):
        self.ledger, self.fold_every = running_ledger(out_path), fold_every

    def __call__(self, changed: DataFrame, batch_id: int) -> None:
        run = run_of(changed)
        self.ledger.write(changed, JOB, run, batch_id)
        fold_now_and_then([self.ledger], changed.sparkSession, JOB, run, batch_id, self.fold_every)


def start_running_word_count(stream: DataFrame, out_path: str, checkpoint: str,
                             text_col: str = "value", trigger: str | None = None,
                             state_partitions: int | None = None,
                             name: str | None = None, output_mode: str = "update",
                             fold_every: int = FOLD_EVERY) -> StreamingQuery:
    """Running count per word, kept in the state store; each batch emits the
    words it changed with their new totals (update mode) into ``out_path``.

    ``output_mode="complete"`` re-emits every known word every batch, as the
    original did; it rewrites the whole vocabulary each time, so update mode
    is the default.  ``running_counts`` reads the current totals either way.
    State is hash-partitioned by word over ``state_partitions`` partitions,
    fixed at the first run of the checkpoint.
    """
    spark = stream.sparkSession
    counts = word_count(stream, text_col)
    writer = (counts.writeStream.outputMode(output_mode)
              .foreachBatch(_WriteChanged(out_path, fold_every))
              .option("checkpointLocation", checkpoint))
    if name:
        writer = writer.queryName(name)
    with session_conf(spark, stateful_settings(spark, state_partitions)):
        return with_trigger(writer, trigger).start()


def running_counts(spark: SparkSession, out_path: str, wanted: Column | None = None) -> DataFrame:
    """Current totals: a state store's counts only grow, so the latest total of
    a word is its largest (a combinable max); every checkpoint counted records
    of its own, so their totals add up.  ``wanted``, a predicate on ``word``, reads
    only those words."""
    found = running_ledger(out_path).find(spark, JOB, F.lit(True) if wanted is None else wanted)
    return found.groupBy("word").agg(F.sum("cnt").alias("cnt"))
