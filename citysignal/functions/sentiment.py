"""Polarity buckets and the tokens polarity is summed over."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from citysignal import config as C

WORD = r"\p{L}+(?:'\p{L}+)*"


def bucket(compound: Column) -> Column:
    """0..9 bucket of a compound polarity: truncated, then clamped."""
    scaled = ((compound + 1) * F.lit(C.SENTIMENT_SCALE)).cast("int")
    return F.least(F.greatest(scaled, F.lit(0)), F.lit(C.SENTIMENT_MAX_BUCKET))


def is_negative(score: Column) -> Column:
    """Negative flag; a message without a score counts as mid-scale."""
    return F.coalesce(score, F.lit(C.MISSING_BUCKET)) < C.NEGATIVE_BELOW_BUCKET


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(f"({WORD})"), F.lit(1))


def compound_of(valence_sum: Column) -> Column:
    """Published normalisation of a valence sum to -1..1."""
    return valence_sum / F.sqrt(valence_sum * valence_sum + F.lit(C.POLARITY_ALPHA))
