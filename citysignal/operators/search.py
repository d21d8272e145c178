"""Message search: keywords, radius, age, and the two orderings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citysignal import config as C
from citysignal.functions import geo
from citysignal.functions import text as text_functions
from citysignal.operators.joins import SMALL_ROWS


def with_keywords(
    posts: DataFrame, keywords: Sequence[str] = C.SEARCH_KEYWORDS, text: str = "text"
) -> DataFrame:
    return posts.filter(text_functions.mentions_any(F.col(text), keywords))


def _mentioned() -> Column:
    """Most keywords are refused by the cheaper test."""
    exact = text_functions.mentions(F.col("_lower"), F.col("keyword"))
    return F.contains("_lower", "keyword") & exact


def with_keyword_table(
    posts: DataFrame,
    keywords: DataFrame,
    text: str = "text",
    broadcast_words: int = SMALL_ROWS,
) -> DataFrame:
    """Posts that mention at least one of a table of keywords, with the sorted ``keywords`` they mention.

    ``keywords`` has words and phrases in a column ``keyword``, as many as wanted; they match like those of
    ``with_keywords``. Texts meet keywords by the keyword's first words, as they are written and apart, up to
    ``text_functions.SPAN_WORDS``; a keyword of no more than those is found by that, and only a longer or
    punctuated one that meets a text is tested on it. Keywords without a letter or digit are left out.
    A text's digest stands for it in between, so repeated ids are no matter.
    """
    listed = keywords.select(F.lower("keyword").alias("keyword")).distinct()
    listed = listed.withColumn("first", text_functions.first_span(F.col("keyword"))).filter("first <> ''")
    sizes = listed.select(F.size(text_functions.search_words(F.col("first"))).alias("size")).distinct()
    sizes = sorted(row["size"] for row in sizes.collect())
    digest = F.sha2(text, 256).alias("_digest")
    lower = F.lower(text).alias("_lower")
    cut = posts.select(digest, lower, *text_functions.cut_words(F.col(text), "_words", "_pieces"))
    spans = F.flatten(F.array(*[text_functions.spans("_words", "_pieces", size) for size in sizes]))
    spans = spans if sizes else F.array().cast("array<string>")
    first = F.explode(F.array_distinct(spans)).alias("first")
    whole = F.col("first") == F.col("keyword")
    if listed.limit(broadcast_words + 1).count() <= broadcast_words:
        # The text stays beside its words, which do not move.
        met = cut.select("_digest", "_lower", first).join(F.broadcast(listed), "first")
        hits = met.filter(whole | _mentioned())
    else:
        near = cut.select("_digest", first).join(listed, "first").distinct()
        texts = posts.select(digest, lower).dropDuplicates(["_digest"])
        tested = near.filter(~whole).join(texts, "_digest").filter(_mentioned())
        hits = near.filter(whole).select("_digest", "keyword").unionAll(tested.select("_digest", "keyword"))
    found = hits.groupBy("_digest").agg(F.array_sort(F.collect_set("keyword")).alias("keywords"))
    return posts.select("*", digest).join(found, "_digest").drop("_digest")


def within_radius(
    rows: DataFrame,
    centre: tuple[float, float] = C.SEARCH_CENTRE,
    radius_km: float = C.SEARCH_RADIUS_KM,
    lat: str = "lat",
    lon: str = "lon",
) -> DataFrame:
    return rows.filter(geo.within_km(F.col(lat), F.col(lon), centre, radius_km))


def since(
    rows: DataFrame, as_of: str | Column, back: str = C.SEARCH_SINCE, ts: str = "ts"
) -> DataFrame:
    end = F.lit(as_of).cast("timestamp") if isinstance(as_of, str) else as_of
    return rows.filter(F.col(ts) >= end - F.expr(f"INTERVAL {back}"))


def search(
    posts: DataFrame,
    *,
    order: str = "latest",
    keywords: Sequence[str] | None = None,
    centre: tuple[float, float] | None = None,
    radius_km: float = C.SEARCH_RADIUS_KM,
    as_of: str | Column | None = None,
    back: str = C.SEARCH_SINCE,
    limit: int = 20,
) -> DataFrame:
    """Posts that meet all given conditions; any of them may be left out.

    ``latest`` orders by time, ``top`` by likes, retweets and replies together.
    """
    found = posts
    if as_of is not None:
        found = since(found, as_of, back)
    if centre is not None:
        found = within_radius(found, centre, radius_km)
    if keywords is not None:
        found = with_keywords(found, keywords)
    engagement = F.col("like_count") + F.col("retweet_count") + F.col("reply_count")
    found = found.withColumn("engagement", engagement)
    rank = {"latest": F.desc("ts"), "top": F.desc("engagement")}[order]
    return found.orderBy(rank, F.asc("tweet_id")).limit(limit)
