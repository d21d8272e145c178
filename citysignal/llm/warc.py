"""WARC archives: a writer with revisit records and a reader that salvages damaged files.

Writing. Each page is one record in its own gzip member. Of pages with the same payload
the one with the smallest id is a response, the others revisit it. A task writes files of
about ``FILE_BYTES`` under names of its own attempt; which files count is what the tasks
return, stored by Spark's committer, so a lost or repeated task leaves no record twice.

Reading. A file is read as a stream, one record at a time. When a check fails (gzip
checksum, version line, length, block digest, closing line), the reader searches for the
next valid gzip member or, in plain files, the next version line; everything in between is
one quarantined gap with its first failure as the reason. Later records are kept.
Truncated last records are gaps as well. An empty file has neither records nor gaps.

Null payloads are empty ones. Pages whose ids are null or repeat are written like others
(a null id is never the smallest while there is another). Repeated rows give repeated
records. An empty table writes no file. Columns other than id, url and html are not read.

Files are reached through Arrow's file systems (local and shared folders, HDFS, S3, GCS).
One file is one task's work, so archives should be cut at sizes that suit a task.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citysignal.llm.common import only, text_of, written

FILE_BYTES = 64 << 20
STEP = 1 << 20
# What is unpacked at once; a broken member loses no more than that before the break.
PIECE = 1 << 16
# Fixed values of the format.
VERSION = b"WARC/1.1"
VERSIONS = (b"WARC/1.0\r\n", b"WARC/1.1\r\n")
MEMBER = b"\x1f\x8b\x08"
CLOSING = b"\r\n\r\n"

ITEM = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("start", T.LongType()),
        T.StructField("stop", T.LongType()),
        T.StructField("gap", T.StringType()),
        T.StructField("headers", T.MapType(T.StringType(), T.StringType())),
        T.StructField("payload", T.BinaryType()),
    ]
)
FILES = "file string, records bigint, bytes bigint"


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(headers: list[tuple[str, str]], payload: bytes) -> bytes:
    lines = b"".join(f"{name}: {value}\r\n".encode() for name, value in headers)
    return b"".join((VERSION, b"\r\n", lines, b"\r\n", payload, CLOSING))


def _file_system(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def page_record(page_id, url: str | None, payload: bytes, original) -> bytes:
    """``original``: the id of the response with the same payload, None for a response."""
    digest = sha1_base32(payload)
    block = payload if original is None else b""
    headers = [
        ("WARC-Type", "response" if original is None else "revisit"),
        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"),
        ("WARC-Target-URI", " ".join((url or "").split())),
        ("X-Page-ID", "" if page_id is None else str(page_id)),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("X-Payload-Length", str(len(payload))),
        ("WARC-Block-Digest", f"sha1:{sha1_base32(block)}"),
        ("Content-Type", "text/html"),
        ("Content-Length", str(len(block))),
    ]
    if original is not None:
        headers.append(("WARC-Refers-To-Page", str(original)))
    return record_bytes(headers, block)


def file_writer(folder: str, file_bytes: int):
    def write(batches):
        import pyarrow as pa

        system, path = _file_system(folder)
        out = name = None
        records = size = 0

        def done():
            out.close()
            return pa.RecordBatch.from_pydict({"file": [name], "records": [records], "bytes": [size]})

        for batch in batches:
            for page_id, url, html, original in zip(
                *(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "original")),
                strict=True,
            ):
                if out is None:
                    name = f"{path}/{uuid.uuid4().hex}.warc.gz"
                    out, records, size = system.open_output_stream(name, compression=None), 0, 0
                made = zlib.compressobj(3, wbits=31)
                record = page_record(page_id, url, html.encode(), original)
                member = made.compress(record) + made.flush()
                out.write(member)
                records, size = records + 1, size + len(member)
                if size >= file_bytes:
                    yield done()
                    out = None
        if out is not None:
            yield done()

    return write


def with_originals(pages: DataFrame, at_least: int = 0) -> DataFrame:
    """``original``: null for responses, else the smallest id with the same payload.

    Only (digest, length, id) is grouped; a payload that many pages share costs one row a
    task. Rows that carry the smallest id again are told apart by their number.
    """
    keyed = only(pages, "page_id", "url", "html").select(
        "page_id",
        "url",
        text_of("html").alias("html"),
        F.sha1(text_of("html")).alias("sha1"),
        F.octet_length(text_of("html")).alias("bytes"),
    )
    first = (
        keyed.where(F.col("bytes") >= at_least)
        .groupBy("sha1", "bytes")
        .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
        .where("copies > 1")
        .drop("copies")
    )
    original = F.when(F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id"))
    return keyed.join(first, ["sha1", "bytes"], "left").select(
        "page_id", "url", "html", original.alias("original")
    )


def write_pages(
    pages: DataFrame, folder: str, at_least: int = 0, file_bytes: int = FILE_BYTES
) -> DataFrame:
    """Writes one record a page below ``folder``; returns the files that count."""
    system, path = _file_system(folder)
    system.create_dir(path, recursive=True)
    records = with_originals(pages, at_least)
    return written(records.mapInArrow(file_writer(folder, file_bytes), FILES), "warc-files")


class _Stream:
    """A file that can be looked at from any later offset, with a buffer of a few steps."""

    def __init__(self, file, size: int):
        self.file, self.size = file, size
        self.base, self.buffer = 0, b""

    def at(self, offset: int, length: int) -> bytes:
        end = min(offset + length, self.size)
        if offset < self.base or end > self.base + len(self.buffer):
            keep = b""
            if self.base <= offset < self.base + len(self.buffer):
                keep = self.buffer[offset - self.base :]
            at = offset + len(keep)
            self.file.seek(at)
            self.buffer = keep + self.file.read(max(end - at, min(STEP, self.size - at)))
            self.base = offset
        return self.buffer[offset - self.base : end - self.base]

    def find(self, offset: int) -> int:
        """Where the next member or version line may start; the size if nowhere."""
        longest = len(VERSIONS[0])
        while offset < self.size:
            part = self.at(offset, STEP)
            found = [n for n in map(part.find, (MEMBER, *VERSIONS)) if n >= 0]
            if found:
                return offset + min(found)
            offset += max(1, len(part) - longest + 1)
        return self.size


class Damaged(Exception):
    pass


def parsed(record: bytes) -> tuple[dict[str, str], bytes, int]:
    """Headers, block and length of the record that starts ``record``; checks all of it."""
    if not record.startswith(VERSIONS):
        raise Damaged("no version line")
    head = record.find(CLOSING)
    if head < 0:
        raise Damaged("headers without end")
    headers = {}
    for line in record[:head].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damaged("header line without colon")
        headers[name.decode("utf-8", "replace").strip()] = value.decode("utf-8", "replace").strip()
    length = next((v for k, v in headers.items() if k.lower() == "content-length"), "")
    if not length.isdecimal():
        raise Damaged("no content length")
    start, stop = head + 4, head + 4 + int(length)
    if len(record) < stop + 4:
        raise Damaged("record cut short")
    if record[stop : stop + 4] != CLOSING:
        raise Damaged("no closing line")
    block = record[start:stop]
    stated = headers.get("WARC-Block-Digest", "")
    if stated.startswith("sha1:") and stated[5:] != sha1_base32(block):
        raise Damaged("block digest differs")
    return headers, block, stop + 4


class _Unpacked:
    """The bytes of the gzip member at ``offset``, unpacked as far as they are asked for."""

    def __init__(self, stream: _Stream, offset: int):
        self.stream, self.at, self.unpack = stream, offset, zlib.decompressobj(wbits=31)
        self.buffer, self.packed = b"", b""
        # Why the member cannot be unpacked any further, if so.
        self.broken = ""

    @property
    def ended(self) -> bool:
        return self.unpack.eof or bool(self.broken)

    @property
    def end(self) -> int:
        """Where the member ends in the file, or how far it was read."""
        return self.at - len(self.unpack.unused_data) - len(self.packed)

    def fill(self, length: int) -> bytes:
        """The buffer with at least ``length`` bytes, fewer only at the member's end or where it breaks."""
        parts, held = [self.buffer], len(self.buffer)
        try:
            while held < length and not self.ended:
                if not self.packed:
                    self.packed = self.stream.at(self.at, PIECE)
                    self.at += len(self.packed)
                    if not self.packed:
                        self.broken = "member cut short"
                        break
                parts.append(self.unpack.decompress(self.packed, STEP))
                self.packed = b"" if self.unpack.eof else self.unpack.unconsumed_tail
                held += len(parts[-1])
        except zlib.error:
            self.broken = "gzip check failed"
        self.buffer = b"".join(parts)
        return self.buffer

    def drop(self, length: int) -> None:
        self.buffer = self.buffer[length:]


def _head(fill) -> tuple[bytes, int]:
    """The first bytes from ``fill``, up to the end of the headers if they have one, and where that is."""
    length = STEP
    while True:
        part = fill(length)
        head = part.find(CLOSING)
        if head >= 0 or len(part) < length or not part.startswith(VERSIONS):
            return part, head
        length *= 2


def _length(part: bytes, head: int) -> int | None:
    """Of the record whose headers end at ``head``: its length in all, by its headers."""
    stated = next(
        (
            line.partition(b":")[2].strip()
            for line in part[: max(head, 0)].split(b"\r\n")
            if line.lower().startswith(b"content-length:")
        ),
        b"",
    )
    return head + 8 + int(stated) if stated.isdigit() else None


def _member(stream: _Stream, offset: int):
    """Yields (start, stop, reason, headers, block) of what the gzip member at ``offset`` holds, returns its end.

    A member may hold several records. One that breaks off or fails its check loses its last record and what
    follows; those before it came whole. In a member that unpacks, a damaged record is passed over up to the next
    version line. Places are those of the file: the member's start, and how far it was read.
    """
    inside, held, gap = _Unpacked(stream, offset), None, None
    while inside.fill(1):
        try:
            part, head = _head(inside.fill)
            length = _length(part, head) if part.startswith(VERSIONS) else None
            headers, block, used = parsed(inside.fill(length) if length else part)
            inside.drop(used)
        except Damaged as error:
            gap = gap or str(error)
            if not _skip(inside):
                break
            continue
        if held:
            yield held
        if gap:
            yield offset, inside.end, gap, None, None
            gap = None
        held = (offset, inside.end, None, headers, block)
    if inside.broken:
        raise Damaged(inside.broken)
    if held:
        yield (*held[:1], inside.end, *held[2:])
    if gap:
        yield offset, inside.end, gap, None, None
    return inside.end


def _skip(inside: _Unpacked) -> bool:
    """Moves on to the next version line in the member; False if there is none."""
    longest = len(VERSIONS[0])
    inside.drop(1)
    while True:
        part = inside.fill(STEP)
        found = [n for n in map(part.find, VERSIONS) if n >= 0]
        if found:
            inside.drop(min(found))
            return True
        if inside.ended:
            inside.drop(len(part))
            return False
        inside.drop(max(1, len(part) - longest + 1))


def _plain(stream: _Stream, offset: int):
    """The same for the record that stands unpacked at ``offset``."""
    # Damage in a length must not make the reader hold the rest of the file: headers come first.
    part, head = _head(lambda length: stream.at(offset, length))
    length = _length(part, head)
    if length is not None:
        if offset + length > stream.size:
            raise Damaged("record cut short")
        part = stream.at(offset, length)
    headers, block, used = parsed(part)
    yield offset, offset + used, None, headers, block
    return offset + used


def salvage(file, size: int):
    """(start, stop, reason, headers, block) of all records and gaps, in order.

    For records the reason is None; for gaps the last two are None.
    """
    stream, at, gap, reason = _Stream(file, size), 0, None, ""
    while at < size:
        found = (_member if stream.at(at, 3) == MEMBER else _plain)(stream, at)
        try:
            while True:
                try:
                    item = next(found)
                except StopIteration as end:
                    stop = end.value
                    break
                if gap is not None:
                    yield gap, at, reason, None, None
                    gap = None
                yield item
        except Damaged as error:
            if gap is None:
                gap, reason = at, str(error)
            at = stream.find(at + 1)
            continue
        if gap is not None:
            yield gap, at, reason, None, None
            gap = None
        at = stop
    if gap is not None:
        yield gap, size, reason, None, None


def read_archives(files: DataFrame) -> DataFrame:
    """Records and quarantined gaps of the files named in column ``file``, one task a file.

    Columns: file, start, stop, gap (the reason; null for records), headers, payload.
    """

    def read(batches):
        import pyarrow as pa

        kind = pa.schema(
            [
                ("file", pa.string()),
                ("start", pa.int64()),
                ("stop", pa.int64()),
                ("gap", pa.string()),
                ("headers", pa.map_(pa.string(), pa.string())),
                ("payload", pa.binary()),
            ]
        )
        for batch in batches:
            for name in batch.column("file").to_pylist():
                system, path = _file_system(name if "://" in name else f"file://{name}")
                rows, held = [], 0
                with system.open_input_file(path) as source:
                    for start, stop, gap, headers, block in salvage(source, source.size()):
                        rows.append((name, start, stop, gap, list((headers or {}).items()), block))
                        held += len(block or b"")
                        if held > 4 * STEP or len(rows) >= 2000:
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(c, f.type) for c, f in zip(zip(*rows), kind)], schema=kind
                            )
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(zip(*rows), kind)], schema=kind
                    )

    names = files.select("file")
    count = max(1, names.count())
    return names.repartition(min(count, 10_000), "file").mapInArrow(read, ITEM)


def page_records(items: DataFrame) -> DataFrame:
    """What the records of ``write_pages`` say of their pages; gaps are left out."""
    head = lambda name: F.col("headers")[name]
    return items.where("gap is null").select(
        F.when(head("X-Page-ID") != "", head("X-Page-ID")).cast("long").alias("page_id"),
        F.coalesce(head("X-Payload-Length"), F.octet_length("payload").cast("string")).cast("long").alias("payload_bytes"),
        F.regexp_replace(head("WARC-Payload-Digest"), "^sha1:", "").alias("payload_digest"),
        head("WARC-Type").alias("record_type"),
        head("WARC-Refers-To-Page").cast("long").alias("refers_to"),
        F.octet_length("payload").cast("long").alias("block_bytes"),
    )


__all__ = [
    "page_records", "read_archives", "salvage", "with_originals", "write_pages",
]
