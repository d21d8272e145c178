"""Keyed tables on Parquet with last-write-wins reads.

A table is a folder of change batches::

    log/writer=W/batch_id=N/dt=D/    rows of one write, replaced as a whole when it is repeated

``dt`` is the date the keys start with, so key ranges prune days. Several writers can feed
one table: batch ids count per writer, and every row carries the time of its write. The last
write of a key wins, as in a key-value store; within a write the order columns decide. With
``source_order`` the order columns decide first, whoever wrote when: give them the source's own time or
offset, and neither a slow clock nor a replay of old batches can bring back an older row. The
time of the write is then a tie-break.
Compaction is a plain job: it writes the current rows into a new table that the caller
names, after which the old folder can be removed.
"""

from __future__ import annotations

import re
import time
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citysignal import config as C
from citysignal.functions import keys
from citysignal.operators import packed
from citysignal.session import cut_lineage
from citysignal.sources import scans

# Keys that a row group's Bloom filter is made for, some 120 KB.
BLOOM_KEYS = 100_000
FIXED_WIDTH = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def latest_per_key(
    changes: DataFrame, key: str | Sequence[str], order: Sequence[str]
) -> DataFrame:
    """The last write of every key.

    ``order`` must be unique within a key; a null in it counts as lowest. Each task sends
    at most one row per key however often a key was written. With a single whole-number
    or decimal order column and only fixed-width values every column competes on its own,
    which stays in the hash aggregate; otherwise whole rows compete, which sorts by key first.
    """
    by = [key] if isinstance(key, str) else list(key)
    rest = [field for field in changes.schema.fields if field.name not in by]
    names = [field.name for field in rest]
    lowest = _lowest(changes.schema[order[0]].dataType) if len(order) == 1 else None
    if lowest is not None and all(isinstance(field.dataType, FIXED_WIDTH) for field in rest):
        rank = F.coalesce(F.col(order[0]), lowest)
        newest = [F.max_by(name, rank).alias(name) for name in names]
        return changes.groupBy(*by).agg(*newest).select(*changes.columns)
    newest = F.max_by(F.struct(*names), F.struct(*order)).alias("newest")
    return changes.groupBy(*by).agg(newest).select(*by, "newest.*").select(*changes.columns)


def _lowest(kind: T.DataType) -> Column | None:
    """The lowest value of a whole-number or decimal type."""
    if isinstance(kind, T.IntegralType):
        return F.lit(packed.LOWEST)
    if isinstance(kind, T.DecimalType):
        whole, places = "9" * (kind.precision - kind.scale), "9" * kind.scale
        return F.lit(f"-{whole or 0}.{places or 0}").cast(kind)
    return None


def retained(
    rows: DataFrame, feed: str, as_of: str, ts: str = "ts", partition: str | None = None
) -> DataFrame:
    """Rows still inside the feed's retention period at ``as_of``.

    With ``partition`` (a ``yyyyMMdd`` folder column) expired folders are pruned.
    """
    oldest = F.lit(as_of).cast("timestamp") - F.expr(f"INTERVAL {C.RETENTION[feed]}")
    kept = rows.filter(F.col(ts) >= oldest)
    if partition:
        kept = kept.filter(F.col(partition) >= F.date_format(oldest, "yyyyMMdd"))
    return kept


class KeyedTable:
    """Upserts, reads and compaction of one table with time-ordered keys."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        key: str = "row_key",
        order: Sequence[str] = ("seq",),
        source_order: bool = False,
    ):
        self.source_order = source_order
        self.spark = spark
        self.path = path.rstrip("/")
        self.key = key
        self.order = list(order)

    @property
    def log_path(self) -> str:
        return f"{self.path}/log"

    def upsert(self, rows: DataFrame, batch_id: int, writer: str = "main") -> None:
        """Write one batch. Repeating a writer's batch id replaces that batch only.

        Rows without a key are refused: the write fails and leaves nothing.
        """
        stamped = rows.withColumn("written_at", F.lit(time.time_ns() // 1000).cast("bigint"))
        placed = self._dated(stamped).hint("rebalance", "dt").sortWithinPartitions("dt", self.key)
        self._write(placed, f"{self.log_path}/writer={writer}/batch_id={batch_id}", "overwrite")

    def _write(self, placed: DataFrame, path: str, mode: str) -> None:
        """Files sorted by key: row groups have narrow key ranges, and a Bloom filter of their keys."""
        (
            placed.write.mode(mode)
            .partitionBy("dt")
            .option(f"parquet.bloom.filter.enabled#{self.key}", "true")
            .option(f"parquet.bloom.filter.expected.ndv#{self.key}", str(BLOOM_KEYS))
            .parquet(path)
        )

    def _dated(self, rows: DataFrame) -> DataFrame:
        key = F.col(self.key)
        missing = F.raise_error(F.lit(f"a row has no {self.key}")).cast("string")
        return rows.withColumn("dt", F.when(key.isNotNull(), keys.key_date(key)).otherwise(missing))

    def log(self) -> DataFrame | None:
        """All logged rows with their ``writer``, ``batch_id`` and ``dt``."""
        try:
            rows = self.spark.read.parquet(self.log_path)
        except AnalysisException as missing:
            if missing.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None
            raise
        return rows.withColumns({name: F.col(name).cast("string") for name in ("writer", "dt")})

    def changes(self) -> DataFrame:
        """Rows a read has to reconcile."""
        log = self.log()
        if log is None:
            raise ValueError(f"nothing was written to {self.path} yet")
        return log

    def _newest(self, rows: DataFrame) -> DataFrame:
        """Last row of every key with the time of its write."""
        rows = rows.drop("writer", "batch_id", "dt")
        if self.source_order:
            return latest_per_key(rows, self.key, [*self.order, "written_at"])
        if len(self.order) == 1 and isinstance(rows.schema[self.order[0]].dataType, T.IntegralType):
            rank = packed.pack(F.col("written_at"), F.col(self.order[0]))
            ranked = rows.withColumn("write_order", rank)
            return latest_per_key(ranked, self.key, ["write_order"]).drop("write_order")
        return latest_per_key(rows, self.key, ["written_at", *self.order])

    def latest(self, *values: Column | str) -> DataFrame:
        """Current row of every key; with ``values``, its key and order columns and these only.

        Values are taken from every logged row before rows compete: with none but numbers and times,
        rows are reduced by hashing, without their strings.
        """
        rows = self.changes()
        if values:
            rows = rows.select(self.key, *self.order, "written_at", *values)
        return self._newest(rows).drop("written_at")

    def get(self, value: str) -> DataFrame:
        """Current row of one key.

        The key test reaches the scan: it opens the key's day, and of its files only the row groups whose
        key range and Bloom filter admit the key.
        """
        return self._newest(scans.get_row(self.changes(), value, self.key)).drop("written_at")

    def days(self) -> list[str]:
        """The ``dt`` folders in order, from the listing of files alone."""
        found = re.findall(r"/dt=([^/]*)/", "\n".join(self.changes().inputFiles()))
        return sorted({unquote(day) for day in found})

    def head(self, n: int) -> DataFrame:
        """The first ``n`` current rows in key order.

        Keys start with their day, so the first days hold the first keys: days are read in order, one,
        then two, four and so on, until ``n`` keys are found. The rows of later days are not read.
        """
        days, taken = self.days(), 1
        while True:
            rows = self.changes()
            if taken < len(days):
                rows = rows.filter(F.col("dt") <= days[taken - 1])
            first = self._newest(rows).drop("written_at").orderBy(self.key).limit(n)
            if taken >= len(days):
                return first
            first = cut_lineage(first)
            if first.count() >= n:
                return first
            taken *= 2

    def scan(self, start: str, stop: str) -> DataFrame:
        """Current rows of a key range, in no particular order."""
        rows = scans.scan_range(self.changes(), start, stop, self.key)
        return self._newest(rows).drop("written_at")

    def compact_into(self, path: str) -> KeyedTable:
        """A new table at ``path`` that holds only the current rows, sorted by key.

        It takes further writes; move the writers there and then drop the old folder. An
        interrupted compaction leaves the old table as it was; use another path for the
        next attempt.
        """
        fresh = KeyedTable(self.spark, path, self.key, self.order, self.source_order)
        placed = self._dated(self._newest(self.changes())).repartitionByRange("dt", self.key)
        placed = placed.sortWithinPartitions("dt", self.key)
        self._write(placed, f"{fresh.log_path}/writer=compacted/batch_id=0", "errorifexists")
        return fresh
