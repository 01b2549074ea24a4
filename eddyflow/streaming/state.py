"""Running state with an update function of the user's, and moving state between
queries.

The built-in running count (``wordcount``) stays the default.  Here each word's
state is any row: ``update(word, n, old)`` gets the number of times the word came in
this batch and the old state (a dict, or None) and returns the new one.  Words are
counted inside each task before the shuffle, so a frequent word costs one row a
task and batch.

A checkpoint's state can be read as a table and given to a new query as its initial
state: that is how the number of state partitions, fixed at a checkpoint's first
run, is changed.
"""

from __future__ import annotations

import sys
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery
from pyspark.sql.types import StructType

from ..operators.wordcount import words
from .runner import session_conf, stateful_settings, with_trigger

register_pickle_by_value(sys.modules[__name__])  # executors need no copy of this module

Update = Callable[[str, int, "dict | None"], dict]
STATE = "value"


def add_up(word: str, n: int, old: dict | None) -> dict:
    """The sum of all counts: the running word count as an update function."""
    return {"cnt": n + (old["cnt"] if old else 0)}


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``word, n`` of one task's words, given out when many are held."""
    held: Counter = Counter()

    def rows() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())],
                                         names=["word", "n"])
        held.clear()
        return out

    for b in batches:
        for pair in b.column("word").value_counts().to_pylist():
            held[pair["values"]] += pair["counts"]
        if len(held) > 1 << 18:
            yield rows()
    if held:
        yield rows()


def _processor(update: Update, state: StructType):
    """The processor; made here so that executors get it by value."""
    names = state.names

    class Updating(StatefulProcessor):
        def init(self, handle) -> None:
            self.held = handle.getValueState(STATE, state)

        def _row(self, word, new):
            import pandas as pd
            return pd.DataFrame({"word": [word]} | {c: [new[c]] for c in names})

        def handleInputRows(self, key, rows, timerValues):
            n = sum(int(part["n"].sum()) for part in rows)
            old = self.held.get() if self.held.exists() else None
            new = update(key[0], n, dict(zip(names, old)) if old is not None else None)
            self.held.update(tuple(new[c] for c in names))
            yield self._row(key[0], new)

        def handleInitialState(self, key, initialState, timerValues) -> None:
            self.held.update(tuple(x.item() if hasattr(x, "item") else x for x in initialState.iloc[0][names]))

        def close(self) -> None:
            pass

    return Updating()


def running_state(stream: DataFrame, update: Update, state: str, text_col: str = "value",
                  initial: DataFrame | None = None) -> DataFrame:
    """``word`` and the columns of ``state`` (DDL) of every word that a batch
    changes.  ``initial``: ``word`` and those columns, the state to start from."""
    kind = StructType.fromDDL(state)
    counted = words(stream, text_col).mapInArrow(_counted, "word string, n bigint")
    start = initial.select("word", *kind.names).groupBy("word") if initial is not None else None
    return counted.groupBy("word").transformWithStateInPandas(
        _processor(update, kind), f"word string, {state}", "Update", "None", start)


def start_running_state(stream: DataFrame, update: Update, state: str, each: Callable[[DataFrame, int], None],
                        checkpoint: str, text_col: str = "value", trigger: str | None = None,
                        state_partitions: int | None = None, initial: DataFrame | None = None) -> StreamingQuery:
    """Run ``running_state``; ``each`` gets the changed words of every batch."""
    spark = stream.sparkSession
    writer = (running_state(stream, update, state, text_col, initial).writeStream.outputMode("update")
              .foreachBatch(each).option("checkpointLocation", checkpoint))
    with session_conf(spark, stateful_settings(spark, state_partitions)):
        return with_trigger(writer, trigger).start()


def stored_state(spark: SparkSession, checkpoint: str, own_update: bool = True) -> DataFrame:
    """``word`` and the state's columns as the checkpoint holds them: of a query
    with an update function, or of the built-in running count (``word, cnt``)."""
    reader = spark.read.format("statestore")
    if own_update:
        return reader.option("stateVarName", STATE).load(checkpoint).select(F.col("key.word").alias("word"), "value.*")
    held = reader.load(checkpoint)
    return held.select(F.col("key.word").alias("word"), F.col(f"value.{held.schema['value'].dataType.names[0]}").alias("cnt"))


def state_partitions(spark: SparkSession, checkpoint: str) -> int:
    """The number of state partitions that a checkpoint was started with."""
    return spark.read.format("state-metadata").load(checkpoint).agg(F.max("numPartitions")).first()[0]
