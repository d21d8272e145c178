"""What several operators share: reading tables, words, folds and checked broadcasts."""

from __future__ import annotations

import contextlib
import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citysignal.operators.joins import small_side
from citysignal.session import cut_lineage, scratch

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SPACES = r"[\x20\x09-\x0D]+"
NO_SPACES = r"[^\x20\x09-\x0D]"

# Rows of a table of one or two numbers that may be broadcast: some 16 bytes each.
ID_ROWS = 2_000_000

# Rows of whole texts that go to Python at once; Spark's own 10,000 are held several times beside the heap.
TEXT_BATCH = 1_000

__all__ = [
    "ID_ROWS", "NO_SPACES", "SPACES", "TEXT_BATCH", "UPPER", "arrow_rows", "cut_lineage", "fold", "lower_ascii",
    "occurrences", "only", "read_table", "restored", "scratch", "shielded", "small_side", "text_of", "words_of",
    "written",
]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def only(df: DataFrame, *names: str) -> DataFrame:
    """The named columns, found by their exact names; others may differ from them by case alone."""
    inner = df.toDF(*(f"c{i}" for i in range(len(df.columns))))
    return inner.select(*(F.col(f"c{df.columns.index(n)}").alias(n) for n in names))


def shielded(df: DataFrame, *names: str) -> DataFrame:
    """All columns as c0, c1, ... and the named ones once more by name."""
    inner = df.toDF(*(f"c{i}" for i in range(len(df.columns))))
    return inner.select("*", *(F.col(f"c{df.columns.index(n)}").alias(n) for n in names))


def restored(df: DataFrame, columns: list[str], text: Column | None = None) -> DataFrame:
    """The columns of before ``shielded``, with another text if one is given."""
    return df.select(
        *(
            (text if name == "text" and text is not None else F.col(f"c{i}")).alias(name)
            for i, name in enumerate(columns)
        )
    )


def text_of(name: str = "text") -> Column:
    """The text, a null one as an empty one."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def words_of(text: Column) -> Column:
    """Runs of characters other than ASCII white space, in order."""
    return F.array_remove(F.split(F.translate(text, "\t\n\x0b\x0c\r", " " * 5), " "), "")


def occurrences(text: Column, chars: str) -> Column:
    """How many of the characters ``chars`` (ASCII) the text has; most texts have none."""
    some = "[" + "".join(f"\\x{ord(c):02X}" for c in chars) + "]"
    counted = F.char_length(text) - F.char_length(F.translate(text, chars, ""))
    return F.when(F.rlike(text, F.lit(some)), counted).otherwise(F.lit(0))


def fold(name: str, parts: int) -> Column:
    """A row's fold, from the checksum of its id as text (a null id: as empty text)."""
    return F.crc32(F.coalesce(F.col(name).cast("string"), F.lit(""))) % parts


@contextlib.contextmanager
def arrow_rows(spark: SparkSession, rows: int = TEXT_BATCH):
    """What runs inside hands batches of at most ``rows`` rows to Python; the session's own setting comes back."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    own = spark.conf.get(name)
    least = rows if int(own) <= 0 else min(rows, int(own))
    spark.conf.set(name, str(least))
    try:
        yield
    finally:
        spark.conf.set(name, own)


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` as a table in the shared folder, read again: computed once, lineage cut."""
    path = scratch(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@functools.lru_cache(maxsize=8)
def byte_table(words_are: str) -> bytes:
    """256 bytes: what each byte of UTF-8 becomes, 32 if it is outside words."""
    lowered = bytearray(range(256))
    lowered[0x41:0x5B] = range(0x61, 0x7B)
    if words_are == "no spaces":
        outside = [0x20, *range(0x09, 0x0E)]
    elif words_are == "letters and digits":
        outside = [*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]
        outside = [b for b in outside if not 0x41 <= b <= 0x5A]
    else:
        raise ValueError(words_are)
    for b in outside:
        lowered[b] = 0x20
    return bytes(lowered)
