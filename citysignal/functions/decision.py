"""Blend, cut, campaign and the published payload."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from citysignal import config as C
from citysignal.functions.keys import CLOCK_TIME


def global_score(
    traffic: Column, weather: Column, sentiment: Column, config: C.ScoringConfig = C.DEFAULT
) -> Column:
    return (
        traffic * F.lit(config.traffic_weight)
        + weather * F.lit(config.weather_weight)
        + sentiment * F.lit(config.sentiment_weight)
    )


def result(score: Column, config: C.ScoringConfig = C.DEFAULT) -> Column:
    """Strictly above the cut shows the ad."""
    return F.when(score > F.lit(config.show_above), F.lit(C.SHOW_AD)).otherwise(F.lit(C.NO_AD))


def campaign(decision: Column, targets: Column) -> Column:
    """A campaign runs only when the ad is shown and somebody is stuck in traffic."""
    targeted = (decision == C.SHOW_AD) & (F.size(targets) > 0)
    return F.when(targeted, F.lit(C.CAMPAIGN)).otherwise(F.lit(""))


def display_time(decided: Column, config: C.ScoringConfig = C.DEFAULT) -> Column:
    return decided + F.expr(f"INTERVAL {config.display_delay}")


def payload() -> Column:
    """JSON body of a decision row, over the columns of the decisions table."""
    return F.to_json(
        F.struct(
            "decision_id",
            F.date_format("decision_time", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
            F.date_format("display_time", CLOCK_TIME).alias("display_time"),
            F.col("decision_result").alias("decision"),
            F.struct(
                F.col("global_score").alias("global"),
                F.col("traffic_score").alias("traffic"),
                F.col("weather_score").alias("weather"),
                F.col("sentiment_score").alias("sentiment"),
            ).alias("metrics"),
            F.struct(
                (F.col("decision_result") == C.SHOW_AD).alias("show_ad"),
                F.col("campaign_type").alias("campaign"),
                F.col("targets"),
            ).alias("action"),
        )
    )
