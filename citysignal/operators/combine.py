"""Bring the signals together and decide."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citysignal import config as C
from citysignal.functions import decision, keys


def combine_signals(
    traffic: DataFrame, weather: DataFrame, sentiment: DataFrame, on: str = "instant"
) -> DataFrame:
    """Scores of every instant for which at least one source has data.

    Inputs carry ``on`` plus ``traffic_score``, ``weather_score`` and
    ``sentiment_score`` respectively, one row per instant. A source without data
    counts as zero.
    """
    joined = traffic.join(weather, on, "full").join(sentiment, on, "full")
    return fill_signals(joined).filter("traffic_found OR weather_found OR sentiment_found")


def fill_signals(joined: DataFrame) -> DataFrame:
    """Found flags and zero defaults for the three score columns."""
    parts = ("traffic", "weather", "sentiment")
    flagged = joined.withColumns(
        {f"{part}_found": F.col(f"{part}_score").isNotNull() for part in parts}
    )
    return flagged.withColumns(
        {f"{part}_score": F.coalesce(f"{part}_score", F.lit(0.0)) for part in parts}
    )


def with_global_score(signals: DataFrame, config: C.ScoringConfig = C.DEFAULT) -> DataFrame:
    return signals.withColumn(
        "global_score",
        decision.global_score(
            F.col("traffic_score"), F.col("weather_score"), F.col("sentiment_score"), config
        ),
    )


def decide(
    signals: DataFrame,
    config: C.ScoringConfig = C.DEFAULT,
    on: str = "instant",
    tz: str = "UTC",
) -> DataFrame:
    """Decision rows of signals with ``targets``, kept only where the ad is shown."""
    scored = with_global_score(signals, config).withColumn(
        "decision_result", decision.result(F.col("global_score"), config)
    )
    none = F.array().cast("array<string>")
    aimed = scored.withColumn(
        "targets",
        F.when(
            F.col("decision_result") == C.SHOW_AD, F.coalesce(F.col("targets"), none)
        ).otherwise(none),
    )
    return aimed.select(
        keys.second_key(F.col(on), tz).alias("decision_id"),
        "traffic_score",
        "weather_score",
        "sentiment_score",
        "global_score",
        "decision_result",
        decision.campaign(F.col("decision_result"), F.col("targets")).alias("campaign_type"),
        "targets",
        keys.wall_clock(F.col(on), tz).alias("decision_time"),
        keys.wall_clock(decision.display_time(F.col(on), config), tz).alias("display_time"),
    )


def rain_with_congestion(rain: DataFrame, traffic: DataFrame, on: str = "window") -> DataFrame:
    """Windows in which it rained while vehicles were stuck.

    Both inputs hold one row per window; on streams both must carry a watermark.
    """
    return rain.filter(F.col("rain") > 0).join(traffic.filter(F.col("congested") > 0), on)
