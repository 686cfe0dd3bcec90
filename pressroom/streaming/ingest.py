"""Continuous ingest: messages to the store, or to a store with a ledger."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from pressroom.operators.dedupe import append_unseen
from pressroom.sources.ledger import commit_batch
from pressroom.sources.messages import decode_messages

# Fixed value: how often the feeds are read again.
PERIOD = "24 hours"


def start_ingest(
    messages: DataFrame, store_path: str, checkpoint: str, period: str | None = None
) -> StreamingQuery:
    """Append the unseen articles of a message stream to the store.

    Without ``period`` the query takes what is there and ends, for use with any scheduler; with
    it (for example ``PERIOD``) it stays up. A batch that fails is run again from the checkpoint,
    and replaying one adds nothing, so a fresh checkpoint is safe too. The store itself is the
    only state: stream deduplication would grow without bound and miss what is already stored.
    """
    trigger = {"processingTime": period} if period else {"availableNow": True}
    return (
        decode_messages(messages).writeStream
        .foreachBatch(lambda batch, _: append_unseen(batch, store_path))
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def start_ledger_ingest(
    messages: DataFrame, root: str, checkpoint: str, source: str = "main", period: str | None = None
) -> StreamingQuery:
    """Commit the batches of a message stream to the ledger store at ``root``: articles and rejects.

    One ``source`` has one checkpoint, since batches are known by their number there; a new checkpoint
    needs a new source. A batch that is run again after its record was written adds nothing.
    """
    trigger = {"processingTime": period} if period else {"availableNow": True}
    return (
        messages.writeStream
        .foreachBatch(lambda df, batch: commit_batch(df, root, batch, source) and None)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
