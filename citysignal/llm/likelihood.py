"""Quality rules: hashed n-gram log-likelihood ratio between a trusted target and the corpus.

Words and pairs of neighbouring words fall into ``BUCKETS`` hash buckets. Two
multinomials over the buckets are counted from all documents: the corpus, and the
trusted target in it. A document's score is the mean over its n-grams of the log ratio
of the two. Counted by rows, copies without labels move their text away from the target;
counted ``by_text``, as the query and the pipeline do, a text counts once however many copies it has,
and is trusted if any copy is. Ratios are kept as whole millionths, so a score never depends on the order of
summing, and every document is decided by the same fixed threshold.

Nulls, empty texts and texts without words have no n-grams: their score is 0 and the base
rules reject them. Rows are judged one by one: repeated rows get equal verdicts, a null id
is never trusted. An empty trusted set or table makes all ratios 0, so only base rules act.
Columns other than the id and the text are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citysignal.llm.common import (
    ID_ROWS,
    NO_SPACES,
    occurrences,
    only,
    restored,
    shielded,
    small_side,
    text_of,
    words_of,
    written,
)

BUCKETS = 16_384
PSEUDO_COUNT = 1.0
SCALE = 1_000_000
# Digests, with two numbers each, that may be broadcast: some 130 bytes each.
TEXT_ROWS = 500_000
# Mean log ratio in millionths below which a document is unlike the trusted ones.
THRESHOLD = -50_000
SPACE_CHARS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
REPEAT_PERCENT = 50


def hashed(docs: DataFrame, *keep: Column) -> DataFrame:
    """The kept columns, the words and ``h``, a hash of each word."""
    return docs.select(*keep, words_of(text_of()).alias("words")).withColumn(
        "h", F.transform("words", lambda w: F.xxhash64(w))
    )


def buckets_of(h: str, buckets: int) -> Column:
    """The buckets of all words, then of all pairs of neighbours."""
    after = lambda i: F.get(F.col(h), i + 1)
    pairs = F.transform(h, lambda x, i: F.pmod(F.xxhash64(x, after(i)), F.lit(buckets)).cast("int"))
    return F.concat(
        F.transform(h, lambda x: F.pmod(x, F.lit(buckets)).cast("int")),
        F.slice(pairs, 1, F.greatest(F.size(h) - 1, F.lit(0))),
    )


def by_digest(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """text, ``copies`` of it in the table, and ``hit``: whether any of them is trusted."""
    digest = F.unhex(F.sha2(text_of(), 256)).alias("digest")
    known = (
        docs.select("doc_id", digest)
        .join(ids, F.col("doc_id") == F.col("trusted_id"), "left")
        .groupBy("digest")
        .agg(
            F.count(F.lit(1)).alias("copies"),
            F.max(F.col("trusted_id").isNotNull().cast("long")).alias("hit"),
        )
        .where("copies > 1 or hit = 1")
    )
    # Other texts have one copy and are not trusted.
    known = small_side(written(known, "known-texts"), TEXT_ROWS)
    return (
        docs.select("text", digest)
        .join(known, "digest", "left")
        .select(
            "text",
            F.coalesce("copies", F.lit(1)).alias("copies"),
            F.coalesce("hit", F.lit(0)).alias("hit"),
        )
    )


def weights(
    docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS, by_text: bool = False
) -> list[int]:
    """Log ratio of target to corpus by bucket, in millionths.

    ``trusted`` has the ids of the target. Counts cover all documents and are summed in
    each task before the shuffle; the driver gets one row a bucket at most. With
    ``by_text`` they are summed by the number of copies as well and divided by it.
    """
    ids = only(trusted, "doc_id").select(F.col("doc_id").alias("trusted_id")).distinct()
    ids = small_side(ids, ID_ROWS)
    docs = only(docs, "doc_id", "text")
    if by_text:
        marked = by_digest(docs, ids)
    else:
        marked = docs.join(ids, F.col("doc_id") == F.col("trusted_id"), "left").select(
            "text", F.lit(1).alias("copies"), F.col("trusted_id").isNotNull().cast("long").alias("hit")
        )
    grams = hashed(marked, F.col("copies"), F.col("hit")).select(
        "copies", "hit", F.explode(buckets_of("h", buckets)).alias("bucket")
    )
    if by_text:
        counted = (
            grams.groupBy("bucket", "copies")
            .agg(F.count(F.lit(1)).alias("raw"), F.sum("hit").alias("target"))
            .groupBy("bucket")
            .agg(*(F.expr(f"sum({x} div copies)").alias(x) for x in ("raw", "target")))
            .collect()
        )
    else:
        counted = (
            grams.groupBy("bucket")
            .agg(F.count(F.lit(1)).alias("raw"), F.sum("hit").alias("target"))
            .collect()
        )
    raw_all = sum(r.raw for r in counted) + PSEUDO_COUNT * buckets
    target_all = sum(r.target for r in counted)
    if not target_all:
        return [0] * buckets
    target_all += PSEUDO_COUNT * buckets
    ratio = [round(SCALE * math.log(raw_all / target_all))] * buckets
    for r in counted:
        p = (r.target + PSEUDO_COUNT) / target_all
        ratio[r.bucket] = round(SCALE * math.log(p / ((r.raw + PSEUDO_COUNT) / raw_all)))
    return ratio


def repeated_words(h: str) -> Column:
    """Words inside 3-word windows that the text has twice or more."""
    ahead = lambda i, n: F.get(F.col(h), i + n)
    windows = F.slice(
        F.transform(h, lambda x, i: F.xxhash64(x, ahead(i, 1), ahead(i, 2))),
        1,
        F.greatest(F.size(h) - 2, F.lit(0)),
    )
    placed = F.sort_array(F.transform(windows, lambda x, i: F.struct(x.alias("w"), i.alias("i"))))

    def twice(sorted_windows: Column) -> Column:
        same = lambda x, i: F.coalesce(F.get(sorted_windows, i)["w"] == x["w"], F.lit(False))
        hits = F.transform(
            sorted_windows, lambda x, i: F.when(same(x, i - 1) | same(x, i + 1), x["i"])
        )
        hits = F.filter(hits, lambda i: i.isNotNull())
        return F.size(
            F.array_distinct(F.flatten(F.transform(hits, lambda i: F.array(i, i + 1, i + 2))))
        )

    # An array of one, so that the sorted windows are made once and named.
    each = F.transform(F.array(placed), twice)
    distinct = F.size(F.array_distinct(windows)) == F.size(windows)
    return F.when(distinct, F.lit(0)).otherwise(F.get(each, 0))


def repeated_lines() -> Column:
    lines = F.filter(F.split(text_of(), "\n"), lambda line: F.rlike(line, F.lit(NO_SPACES)))
    return F.aggregate(
        F.array(lines), F.lit(0), lambda n, x: n + F.size(x) - F.size(F.array_distinct(x))
    )


def verdicts(
    docs: DataFrame, ratio: list[int], threshold: int = THRESHOLD, *keep: str
) -> DataFrame:
    """``keep`` columns, the base counts, ``score`` (mean log ratio) and ``kept``, by row."""
    buckets = len(ratio)
    table = F.split(F.lit(",".join(map(str, ratio))), ",").cast("array<bigint>")
    measured = hashed(
        docs,
        *(F.col(name) for name in keep),
        F.char_length(F.translate(text_of(), SPACE_CHARS, "")).cast("long").alias("word_chars"),
        occurrences(text_of(), SYMBOLS).cast("long").alias("n_symbols"),
        repeated_lines().cast("long").alias("n_dup_lines"),
    )
    measured = measured.select(
        *keep,
        F.size("words").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        repeated_words("h").cast("long").alias("n_repeat_words"),
        F.aggregate(
            buckets_of("h", buckets), F.lit(0).cast("long"), lambda a, b: a + F.get(table, b)
        ).alias("total"),
    )
    grams = F.greatest(2 * F.col("n_words") - 1, F.lit(1))
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words")
    )
    return measured.select(
        *keep,
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & (F.col("total") >= threshold * grams)).alias("kept"),
        (F.col("total") / (grams * SCALE)).alias("score"),
    )


def filtered(docs: DataFrame, ratio: list[int], threshold: int = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    inner = shielded(docs, "text")
    names = [f"c{i}" for i in range(len(docs.columns))]
    # Stored first: a filter pushed into the measures would compute them again and again.
    judged = written(verdicts(inner, ratio, threshold, *names), "quality")
    return restored(judged.where("kept"), docs.columns)
