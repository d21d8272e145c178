"""Serving record: the latest state of every area."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citysignal import config as C
from citysignal.operators.store import latest_per_key

# Levels shown to displays; lower bounds of the score.
LEVELS = ((0.66, "HIGH"), (0.33, "MEDIUM"))


def level(score):
    return F.coalesce(
        *[F.when(score >= F.lit(floor), F.lit(name)) for floor, name in LEVELS], F.lit("LOW")
    )


def latest_state(
    decisions: DataFrame, area: str = "area", order: Sequence[str] = ("decision_id",)
) -> DataFrame:
    """Congestion, weather and sentiment level and the decision of each area."""
    return served(latest_per_key(decisions, area, order), area)


def served(newest: DataFrame, area: str = "area") -> DataFrame:
    """The record of each area from its latest decision."""
    return newest.select(
        area,
        "decision_id",
        level(F.col("traffic_score")).alias("congestion_level"),
        level(F.col("weather_score")).alias("weather_level"),
        level(F.col("sentiment_score")).alias("negativity_level"),
        (F.col("decision_result") == C.SHOW_AD).alias("show_ad"),
    )
