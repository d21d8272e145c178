"""Sorted arrays of 64-bit keys in files that workers map into memory and search.

A table of (key, value, name) is cut into shards by the highest bits of the key. A task sorts one
shard and writes it to the shared folder as plain arrays: the keys in unsigned order,
values, name offsets, names. Keys are hashes, so that shards are even; their number follows
from a count. Workers map the files: pages of them are read when a search touches them and may
be dropped again, so a list may be larger than a worker's memory.

Where the shared folder is mounted, workers map the files there. Elsewhere Spark ships them to
every executor's own folder (``SparkContext.addFile``), which needs the list's size in disk.
Every attempt of a task writes a file of its own name; the table of files names those of
the attempts that counted, so a lost executor leaves at most an unused file behind.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citysignal.llm.common import scratch, written

# Keys of a shard: some 60 MB with names of 40 bytes.
SHARD_KEYS = 1 << 20
FILES = "shard bigint, file string, rows bigint"
_MAPS: dict[str, Shard] = {}


def plain_path(uri: str) -> str:
    """A local path without its scheme; other addresses as they are."""
    if not uri.startswith("file:"):
        return uri
    return "/" + uri.removeprefix("file:").lstrip("/")


def packed(keys: np.ndarray, values: np.ndarray, names: list[bytes]) -> bytes:
    """A shard's file: number of keys, keys, values, where names end, names."""
    order = np.argsort(keys, kind="stable")
    names = [names[i] for i in order.tolist()]
    ends = np.cumsum([0, *map(len, names)], dtype=np.int64)
    head = np.array([len(keys)], np.int64)
    arrays = head, keys[order].astype(np.uint64), values[order].astype(np.int64), ends
    return b"".join([*(a.tobytes() for a in arrays), *names])


class Shard:
    """A mapped file. Equal keys stand side by side, with a name each."""

    def __init__(self, data: np.ndarray):
        n = int(data[:8].view(np.int64)[0])
        self.keys = data[8 : 8 + 8 * n].view(np.uint64)
        self.values = data[8 + 8 * n : 8 + 16 * n].view(np.int64)
        self.ends = data[8 + 16 * n : 16 + 24 * n].view(np.int64)
        self.names = data[16 + 24 * n :]

    def first(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each key would stand, and whether it stands there."""
        at = np.searchsorted(self.keys, keys)
        inside = at < len(self.keys)
        there = inside.copy()
        there[inside] = self.keys[at[inside]] == keys[inside]
        return at, there

    def confirmed(self, at: int, key: int, name: bytes) -> int | None:
        """The value of the entry with this key that has this very name."""
        while at < len(self.keys) and int(self.keys[at]) == key:
            begin, end = int(self.ends[at]), int(self.ends[at + 1])
            if end - begin == len(name) and self.names[begin:end].tobytes() == name:
                return int(self.values[at])
            at += 1
        return None


def mapped(path: str) -> Shard:
    """This worker's view of a file."""
    if path not in _MAPS:
        place = path
        if not os.path.exists(place):
            from pyspark import SparkFiles

            place = SparkFiles.get(os.path.basename(path))
        _MAPS[path] = Shard(np.memmap(place, np.uint8, "r"))
    return _MAPS[path]


@dataclass(frozen=True)
class SortedKeys:
    """The shards' files in the order of their keys."""

    bits: int
    files: dict[int, str]

    def _by_shard(self, keys: np.ndarray):
        shard = np.zeros(len(keys), np.int64)
        if self.bits:
            shard = (keys >> np.uint64(64 - self.bits)).astype(np.int64)
        for s in np.unique(shard).tolist():
            if s in self.files:
                yield np.flatnonzero(shard == s), mapped(self.files[s])

    def confirm(self, keys: np.ndarray, names: list[bytes]) -> list[int | None]:
        """The value of each name that is stored; None for the others."""
        out: list[int | None] = [None] * len(names)
        for rows, shard in self._by_shard(keys):
            at, there = shard.first(keys[rows])
            for i, j in zip(rows[there].tolist(), at[there].tolist(), strict=True):
                out[i] = shard.confirmed(j, int(keys[i]), names[i])
        return out

    def values(self, keys: np.ndarray) -> np.ndarray:
        """Values of keys that are all stored, once each."""
        out = np.zeros(len(keys), np.int64)
        for rows, shard in self._by_shard(keys):
            at, there = shard.first(keys[rows])
            out[rows[there]] = shard.values[at[there]]
        return out


def store(rows: DataFrame, purpose: str, shard_keys: int = SHARD_KEYS, ship: bool = False) -> SortedKeys:
    """Writes ``rows`` (key bigint, value bigint, name string) and tells where they are.

    ``ship`` sends the files to the executors even where the folder is mounted.
    """
    spark = rows.sparkSession
    rows = written(rows.select("key", "value", "name"), f"{purpose}-rows")
    count = rows.count()
    bits = max(0, (max(count, 1) - 1) // shard_keys).bit_length()
    folder = plain_path(scratch(spark, purpose))

    def write(table):
        from pyarrow import fs

        shard = table.column("shard")[0].as_py()
        keys = table.column("key").to_numpy().view(np.uint64)
        names = [x or b"" for x in table.column("name").cast(pa.binary()).to_pylist()]
        body = packed(keys, table.column("value").to_numpy(), names)
        files, place = fs.FileSystem.from_uri(folder)
        files.create_dir(place, recursive=True)
        name = f"{shard}-{uuid.uuid4().hex}.keys"
        with files.open_output_stream(f"{place}/{name}") as out:
            out.write(body)
        return pa.table({"shard": [shard], "file": [f"{folder}/{name}"], "rows": [len(keys)]})

    shard = F.shiftrightunsigned("key", 64 - bits) if bits else F.lit(0).cast("long")
    files = written(
        rows.withColumn("shard", shard).groupBy("shard").applyInArrow(write, FILES), f"{purpose}-files"
    )
    names = {row.shard: row.file for row in files.collect()}
    if ship or not folder.startswith("/"):
        for name in names.values():
            spark.sparkContext.addFile(name)
        if ship:
            names = {s: os.path.basename(name) for s, name in names.items()}
    return SortedKeys(bits, names)
