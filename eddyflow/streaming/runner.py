"""Starting, triggering and waiting for streaming queries."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ..session import ROCKSDB_PROVIDER

BATCH_INTERVAL = "5 seconds"  # processing-time trigger of the original jobs
STATE_PROVIDER_CONF = "spark.sql.streaming.stateStore.providerClass"
CHANGELOG_CONF = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"


@contextlib.contextmanager
def session_conf(spark: SparkSession, settings: dict[str, str | None]) -> Iterator[None]:
    """Set SQL confs for the start of one query, then restore them.  Confs
    that shape state (partition count, provider) are recorded in the
    checkpoint at the first run, so later restarts keep them."""
    old = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            if v is not None:
                spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def stateful_settings(spark: SparkSession, state_partitions: int | None) -> dict[str, str | None]:
    """State in RocksDB (bounded memory for an unbounded key set) unless the
    session names a provider, with changelog checkpointing (a batch commits
    its changes, not a state snapshot); state partitions as asked."""
    settings: dict[str, str | None] = {}
    provider = spark.conf.get(STATE_PROVIDER_CONF, None)
    if provider in (None, "", "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"):
        settings[STATE_PROVIDER_CONF] = provider = ROCKSDB_PROVIDER
    if provider == ROCKSDB_PROVIDER and spark.conf.get(CHANGELOG_CONF, "false") != "true":
        settings[CHANGELOG_CONF] = "true"
    if state_partitions:
        settings["spark.sql.shuffle.partitions"] = str(state_partitions)
    return settings


def with_trigger(writer: DataStreamWriter, trigger: str | None) -> DataStreamWriter:
    """``trigger``: ``"available_now"``, ``"once"``, a processing interval such
    as ``"5 seconds"``, or None for the default interval of the jobs."""
    if trigger == "available_now":
        return writer.trigger(availableNow=True)
    if trigger == "once":
        return writer.trigger(once=True)
    return writer.trigger(processingTime=trigger or BATCH_INTERVAL)


def run_to_end(query: StreamingQuery, timeout_s: float | None = None) -> StreamingQuery:
    """Wait for an ``availableNow``/``once`` query; raise its error if any."""
    finished = query.awaitTermination(timeout_s) if timeout_s else query.awaitTermination()
    if finished is False:
        query.stop()
        raise TimeoutError(f"streaming query {query.name or query.id} did not finish in {timeout_s}s")
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return query
