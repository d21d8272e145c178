"""Text predicates and list rendering."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

_META = re.compile(r"([\\.^$|?*+()\[\]{}])")


def keyword_pattern(keywords: Iterable[str]) -> str:
    """Alternation of whole words or phrases, bounded by non-letters."""
    escaped = "|".join(_META.sub(r"\\\1", word.lower()) for word in keywords)
    return rf"(^|[^\p{{L}}\p{{N}}])({escaped})($|[^\p{{L}}\p{{N}}])"


def mentions_any(text: Column, keywords: Iterable[str]) -> Column:
    """True where the text holds at least one of the keywords, ignoring case."""
    return F.lower(text).rlike(keyword_pattern(keywords))


WORD = r"[\p{L}\p{N}]+"


def search_words(text: Column) -> Column:
    """Runs of letters and digits in lower case, as keywords are bounded by."""
    return F.regexp_extract_all(F.lower(text), F.lit(f"({WORD})"), F.lit(1))


# Words of a keyword by which it meets texts.
SPAN_WORDS = 3
_APART = r"[^\p{L}\p{N}]"


def first_span(keyword: Column) -> Column:
    """The first words of a keyword with what is between them, empty for a keyword without words."""
    return F.regexp_extract(keyword, rf"{WORD}(?:{_APART}+{WORD}){{0,{SPAN_WORDS - 1}}}", 0)


def cut_words(text: Column, words: str, pieces: str) -> list[Column]:
    """The words of a text in lower case, and each with what follows it up to the next."""
    follows = F.regexp_extract_all(F.lower(text), F.lit(f"({WORD}{_APART}*)"), F.lit(1))
    return [search_words(text).alias(words), follows.alias(pieces)]


def spans(words: str, pieces: str, size: int) -> Column:
    """All stretches of ``size`` words of a text as they are written; null where fewer words precede."""

    def ending(word: Column, at: Column) -> Column:
        before = [F.get(F.col(pieces), at - back) for back in range(size - 1, 0, -1)]
        return F.concat(*before, word)

    return F.transform(F.col(words), ending)


def mentions(text: Column, keyword: Column) -> Column:
    """``mentions_any`` for a keyword from a column."""
    quoted = F.replace(F.lower(keyword), F.lit("\\E"), F.lit("\\E\\\\E\\Q"))
    edge = r"[^\p{L}\p{N}]"
    pattern = F.concat(F.lit(rf"(^|{edge})\Q"), quoted, F.lit(rf"\E($|{edge})"))
    return F.rlike(F.lower(text), pattern)


def joined_hashtags(tags: Column, prefix: str = "") -> Column:
    """Comma-joined texts of a hashtag array, empty string for none.

    A prefix asks for the cleaned form: empty tags are left out.
    """
    if prefix:
        tags = F.filter(tags, lambda tag: tag["text"] != "")
    texts = F.transform(tags, lambda tag: F.concat(F.lit(prefix), tag["text"]))
    return F.when(F.size(tags) > 0, F.concat_ws(",", texts)).otherwise(F.lit(""))


def first_filled(*options: Column) -> Column:
    """The first option that is neither null nor empty."""
    return F.coalesce(*[F.nullif(option, F.lit("")) for option in options])


def quoted_list(items: Column) -> Column:
    """``['a', 'b']`` rendering of a string array, ``[]`` for none."""
    quoted = F.transform(items, lambda item: F.concat(F.lit("'"), item, F.lit("'")))
    return F.concat(F.lit("["), F.coalesce(F.array_join(quoted, ", "), F.lit("")), F.lit("]"))
