"""Micro-batch ingest into keyed tables."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from citysignal.operators.store import KeyedTable


def writer_of(checkpoint: str) -> str:
    """Name of the writer that a checkpoint stands for: a fresh one is another writer."""
    return hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:16]


def once(rows: DataFrame, identity: Sequence[str], ts: str, lateness: str = "1 day") -> DataFrame:
    """The first delivery of every row of a stream.

    For keys cut from the time of processing: a message that is delivered again would get another
    key. Rows with the same ``identity`` count as one. State is kept for ``lateness`` behind
    the newest ``ts``, the time the row speaks of; what is older is late, and dropped whether it
    was seen or not. ``ts`` must be the same in every delivery.
    """
    return rows.withWatermark(ts, lateness).dropDuplicatesWithinWatermark(list(identity))


def keep_latest(
    rows: DataFrame,
    table: KeyedTable,
    checkpoint: str,
    *,
    every: str | None = "30 seconds",
) -> StreamingQuery:
    """Keep the last row of every key of ``table`` up to date, by the table's order columns.

    State holds one row a key. Each batch emits the keys that changed (update mode) and merges them
    into the table; rows that come out of order change nothing.
    """
    rest = [name for name in rows.columns if name != table.key]
    order = F.struct(*table.order)
    newest = rows.groupBy(table.key).agg(F.max_by(F.struct(*rest), order).alias("newest"))
    started = (
        newest.select(table.key, "newest.*")
        .writeStream.foreachBatch(batch_writer(table, writer_of(checkpoint)))
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
    )
    if every is None:
        return started.trigger(availableNow=True).start()
    return started.trigger(processingTime=every).start()


def batch_writer(table: KeyedTable, writer: str = "main") -> Callable[[DataFrame, int], None]:
    """Upsert of a micro-batch. Executors write; nothing is brought to the driver.

    A failure is left to end the query. On restart Spark repeats the batch under
    the same id, which replaces whatever the failed attempt had written.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        table.upsert(batch, batch_id, writer)

    return write


def ingest(
    rows: DataFrame,
    table: KeyedTable,
    checkpoint: str,
    *,
    every: str | None = "30 seconds",
    writer: str | None = None,
) -> StreamingQuery:
    """Start ingesting; ``every=None`` works off what is there and stops.

    Batches are filed under ``writer``, by default one per checkpoint folder. Name it to
    replay a stream from its start in place of what it wrote before.
    """
    named = writer or writer_of(checkpoint)
    started = (
        rows.writeStream.foreachBatch(batch_writer(table, named))
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
    )
    if every is None:
        return started.trigger(availableNow=True).start()
    return started.trigger(processingTime=every).start()


def ingest_all(
    rows: DataFrame, table: KeyedTable, checkpoint: str, writer: str | None = None
) -> KeyedTable:
    """Work off everything available, then return the table."""
    ingest(rows, table, checkpoint, every=None, writer=writer).awaitTermination()
    return table
