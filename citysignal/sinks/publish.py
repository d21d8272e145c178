"""Publishing decisions as keyed JSON records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citysignal.functions import decision


def payloads(decisions: DataFrame) -> DataFrame:
    """``(key, value)`` records of decision rows."""
    return decisions.select(F.col("decision_id").alias("key"), decision.payload().alias("value"))


def placed(records: DataFrame, partitions: int) -> DataFrame:
    """Records with the topic ``partition`` of their key, each partition in one task and in key order.

    A topic partition keeps the order in which records reach it, so only one task may write to
    it; several partitions are written side by side. A record streams through its task.
    """
    chosen = (F.crc32("key") % partitions).cast("int").alias("partition")
    dealt = records.select("*", chosen).repartition(partitions, "partition")
    return dealt.sortWithinPartitions("partition", "key")


def publish(
    decisions: DataFrame,
    target: str,
    *,
    format: str = "kafka",
    servers: str | None = None,
    mode: str = "append",
    partitions: int | None = None,
) -> None:
    """Write decision records in key order.

    ``partitions`` is the topic's number of partitions, one by default; a key always goes to
    the same one. Files without it come out range-partitioned and sorted, so reading the parts by
    name gives the global order without sending everything through one task.
    """
    records = payloads(decisions)
    if format == "kafka":
        (
            placed(records, partitions or 1)
            .write.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("topic", target)
            .save()
        )
        return
    if partitions:
        ordered = placed(records, partitions)
    else:
        ordered = records.repartitionByRange("key").sortWithinPartitions("key")
    ordered.write.format(format).mode(mode).save(target)
