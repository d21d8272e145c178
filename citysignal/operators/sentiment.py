"""Message polarity and the share of negative messages."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citysignal.functions import sentiment
from citysignal.operators.joins import SMALL_ROWS, small_side

# Words of a lexicon that may travel with the plan; published ones have some thousands.
LEXICON_WORDS = 100_000
# Valences are kept as whole ten-thousandths, so sums do not depend on their order.
VALENCE_SCALE = 10_000
_WORDS_PER_MAP = 4


def valence_lookup(lexicon: DataFrame, most: int = LEXICON_WORDS) -> Callable[[Column], Column]:
    """A builder of columns: the valence of a word in ten-thousandths, null for other words.

    The lexicon becomes one constant, small maps in the places of an array by the word's hash, so a
    lookup costs the same for any lexicon, needs no join and works on streams.
    """
    scaled = F.col("valence").cast("decimal(9,4)") * VALENCE_SCALE
    words = lexicon.select("word", scaled.cast("bigint").alias("valence"))
    n = words.limit(most + 1).count()
    if n > most:
        raise ValueError(f"more than {most} words: use score_text, which joins the lexicon")
    places = max(1, n // _WORDS_PER_MAP)

    def place(word: Column) -> Column:
        return F.pmod(F.xxhash64(word), F.lit(places)).cast("int")

    maps: list[dict[str, int]] = [{} for _ in range(places)]
    for row in words.select("word", "valence", place(F.col("word")).alias("place")).collect():
        maps[row.place][row.word] = row.valence
    table = F.from_json(F.lit(json.dumps(maps)), "array<map<string,bigint>>")
    return lambda word: table[place(word)][word]


def score_rows(
    docs: DataFrame, lexicon: DataFrame, *, text: str = "text", most: int = LEXICON_WORDS
) -> DataFrame:
    """Add ``matches``, ``valence`` and ``compound`` to every row, each from its own text.

    Rows neither meet nor move: repeated ids, also with different texts, get a score each,
    and an append stream stays one.
    """
    valence_of = valence_lookup(lexicon, most)
    known = F.filter(
        F.transform(sentiment.words(F.col(text)), valence_of), lambda valence: valence.isNotNull()
    )
    # An array of one, so that the known valences are made once and named.
    summed = F.transform(
        F.array(F.coalesce(known, F.array().cast("array<bigint>"))),
        lambda found: F.struct(
            F.size(found).cast("bigint").alias("matches"),
            F.aggregate(found, F.lit(0).cast("bigint"), lambda a, b: a + b).alias("total"),
        ),
    )
    scored = docs.withColumn("_found", F.get(summed, 0))
    valence = F.col("_found.total") / F.lit(float(VALENCE_SCALE))
    return (
        scored.withColumn("matches", F.col("_found.matches"))
        .withColumn("valence", valence)
        .withColumn("compound", sentiment.compound_of(F.col("valence")))
        .drop("_found")
    )


def score_text(
    docs: DataFrame,
    lexicon: DataFrame,
    *,
    id: str,
    text: str = "text",
    broadcast_words: int = SMALL_ROWS,
) -> DataFrame:
    """``(id, matches, valence, compound)`` of every distinct text of every id, in batch.

    For lexicons of any size; ``score_rows`` scores rows in place. ``lexicon`` is a table
    ``(word, valence)`` with unique words. It is broadcast
    only after counting it; a larger one is joined by shuffle on the word, where
    the adaptive planner splits the rows of very common words. Valences are summed
    as decimals with four places, so the result does not depend on the order.

    A feed that is polled again repeats messages: copies of an id's text are counted, and the
    sums are divided by their number, so that a repeated message scores as one. An id with
    several texts gets a row for each.
    """
    words = lexicon.select("word", F.col("valence").cast("decimal(9,4)").alias("valence"))
    words = small_side(words, broadcast_words)
    tokens = docs.select(
        id,
        F.sha2(text, 256).alias("_digest"),
        F.posexplode_outer(sentiment.words(F.col(text))).alias("at", "word"),
    )
    copies = F.count_if(F.coalesce("at", F.lit(0)) == 0)
    summed = (
        tokens.join(words, "word", "left")
        .groupBy(id, "_digest")
        .agg(
            (F.count("valence") / copies).cast("bigint").alias("matches"),
            (F.coalesce(F.sum("valence").cast("double"), F.lit(0.0)) / copies).alias("valence"),
        )
        .drop("_digest")
    )
    return summed.withColumn("compound", sentiment.compound_of(F.col("valence")))


def score_with(
    docs: DataFrame, scorer: Callable[[Column], Column], *, text: str = "text"
) -> DataFrame:
    """Add ``compound`` from a scorer of your own, such as a Pandas UDF."""
    return docs.withColumn("compound", scorer(F.col(text)))


def bucketed(scored: DataFrame, compound: str = "compound") -> DataFrame:
    return scored.withColumn("sentiment_score", sentiment.bucket(F.col(compound)))


def negative_share(tweets: DataFrame, length: str, slide: str | None = None) -> DataFrame:
    """Share of negative messages per window, over rows ``(ts, sentiment_score)``.

    Sliding windows add up the counts of their steps, so messages are counted once.
    """
    negative = sentiment.is_negative(F.col("sentiment_score"))
    counted = tweets.groupBy(F.window("ts", slide or length).alias("window")).agg(
        F.count("*").alias("tweets"), F.count_if(negative).alias("negative")
    )
    if slide:
        covering = F.window(F.window_time("window"), length, slide).alias("window")
        counted = counted.groupBy(covering).agg(
            F.sum("tweets").alias("tweets"), F.sum("negative").alias("negative")
        )
    share = (F.col("negative") / F.col("tweets")).cast("double")
    return counted.withColumn("sentiment_ratio", share)
