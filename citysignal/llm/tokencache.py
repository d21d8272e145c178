"""Token counts behind a digest cache.

A text's key is the SHA-256 of its UTF-8 bytes; the tokenizer's key is the SHA-256 of its
file, the library's version and the options in force. Stored counts are a Parquet table
(content, n_tokens) in one folder per tokenizer key. A run joins the keys of its texts
to the stored ones, encodes each distinct text that is missing once, appends the counts,
and joins all rows to them. Content is normalised only in that a null text is an empty
one: anything more could change a count.

Lost executors: misses are written by Spark's committer, so a run that fails leaves no
partial rows; a run that is repeated finds them stored. Two runs at once may store a
text twice, with equal counts; readers take one.

Counting inside a task: the library's normaliser works on composed characters and its
pre-tokenizer never keeps white space, so a text's count is the sum over its chunks between
ASCII white space. ``chunked=True`` says that this holds for the tokenizer; then each
distinct chunk is encoded once a worker (a memo of at most ``MEMO`` chunks, emptied when
full). ``chunked=False`` encodes whole texts.

Repeated rows and null ids keep their rows. Empty texts count 0 tokens. Other columns are
not read. An empty table gives no rows and stores nothing.
"""

from __future__ import annotations

import hashlib
import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citysignal.llm.common import arrow_rows, only, text_of

MEMO = 400_000
SCHEMA = "content binary, n_tokens bigint"
_MEMOS: dict[str, tuple] = {}


def tokenizer_digest(path: str) -> str:
    """Names the tokenizer's file, the library's version and the options of counting."""
    import tokenizers

    with open(path, "rb") as file:
        found = hashlib.sha256(file.read())
    found.update(f"|tokenizers {tokenizers.__version__}|no added tokens".encode())
    return found.hexdigest()


def _loaded(path: str) -> tuple:
    """This worker's tokenizer and memo of counts."""
    if path not in _MEMOS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        _MEMOS[path] = (tokenizer, {})
    return _MEMOS[path]


def count_tokens(path: str, texts: list[str], chunked: bool) -> list[int]:
    tokenizer, memo = _loaded(path)
    if not chunked:
        encoded = tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [len(e) for e in encoded]
    counts = []
    for text in texts:
        chunks = text.encode().split()
        missing = [c for c in set(chunks) if c not in memo]
        if missing:
            if len(memo) + len(missing) > MEMO:
                memo.clear()
                missing = list(set(chunks))
            encoded = tokenizer.encode_batch_fast(
                [c.decode() for c in missing], add_special_tokens=False
            )
            memo.update(zip(missing, map(len, encoded), strict=True))
        counts.append(sum(map(memo.__getitem__, chunks)))
    return counts


def encoder(path: str, chunked: bool):
    def encode(batches):
        import pyarrow as pa

        for batch in batches:
            counts = count_tokens(path, batch.column("body").to_pylist(), chunked)
            yield pa.RecordBatch.from_arrays(
                [batch.column("content"), pa.array(counts, pa.int64())], ["content", "n_tokens"]
            )

    return encode


def token_counts(docs: DataFrame, tokenizer: str, cache: str, chunked: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_tokens for every row; ``cache`` is a folder that all can reach."""
    spark = docs.sparkSession
    keyed = only(docs, "doc_id", "text").select(
        "doc_id",
        text_of().alias("body"),
        F.unhex(F.sha2(text_of(), 256)).alias("content"),
    )
    store = f"{cache.rstrip('/')}/{tokenizer_digest(tokenizer)}"
    # An append of no rows makes the folder, so that the first run can read it as well.
    spark.createDataFrame([], SCHEMA).write.mode("append").parquet(store)
    stored = spark.read.schema(SCHEMA).parquet(store)
    # Copies are dropped in each task before the shuffle: no digest carries more than a row a task.
    missing = (
        keyed.join(stored.select("content"), "content", "left_anti")
        if not stored.isEmpty()
        else keyed
    )
    missing = missing.groupBy("content").agg(F.first("body").alias("body"))
    with arrow_rows(spark):
        missing.mapInArrow(encoder(tokenizer, chunked), SCHEMA).write.mode("append").parquet(store)
    known = (
        spark.read.schema(SCHEMA)
        .parquet(store)
        .groupBy("content")
        .agg(F.first("n_tokens").alias("n_tokens"))
    )
    sized = keyed.select("doc_id", "content", F.octet_length("body").cast("long").alias("n_bytes"))
    return sized.join(known, "content").select("doc_id", "n_bytes", "n_tokens")
