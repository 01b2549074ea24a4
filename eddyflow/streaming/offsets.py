"""Recording consumed offsets from a record stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators.offsets import batch_offsets
from .ledger import FOLD_EVERY, fold_now_and_then, offset_ledger, run_of
from .runner import with_trigger


class OffsetLedgerBatch:
    """``foreachBatch`` body: one ledger row per topic partition of the batch
    (exclusive end), in the batch's own folder.  An empty batch writes
    nothing, so the stored resume point stays where it was."""

    def __init__(self, ledger: str, group_id: str, fold_every: int = FOLD_EVERY):
        self.ledger = offset_ledger(ledger)
        self.group_id = group_id
        self.fold_every = fold_every

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        run = run_of(batch)
        self.ledger.write(batch_offsets(batch, self.group_id), self.group_id, run, batch_id)
        fold_now_and_then([self.ledger], batch.sparkSession, self.group_id, run, batch_id, self.fold_every)


def start_offset_ledger(records: DataFrame, ledger: str, group_id: str, checkpoint: str,
                        trigger: str | None = None, fold_every: int = FOLD_EVERY) -> StreamingQuery:
    writer = (records.writeStream.foreachBatch(OffsetLedgerBatch(ledger, group_id, fold_every))
              .option("checkpointLocation", checkpoint))
    return with_trigger(writer, trigger).start()
