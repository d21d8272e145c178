"""Forecast tables to weather scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citysignal import config as C
from citysignal.functions import keys
from citysignal.functions.weather import WeatherFactors
from citysignal.operators.joins import small_side
from citysignal.session import cut_lineage


def factors(forecast: DataFrame, config: C.ScoringConfig = C.DEFAULT) -> DataFrame:
    """Points of each factor beside the forecast columns."""
    return forecast.withColumns(WeatherFactors.of_forecast(config).points())


def scores(
    forecast: DataFrame, hour: Column | None = None, config: C.ScoringConfig = C.DEFAULT
) -> DataFrame:
    """Weather score of each forecast row; ``hour`` defaults to the hour in its key."""
    if hour is None:
        hour = keys.key_hour_of_day(F.col("row_key")).cast("int")
    return forecast.withColumn(
        "weather_score", WeatherFactors.of_forecast(config).score(hour, config)
    )


def hourly_scores(forecast: DataFrame, config: C.ScoringConfig = C.DEFAULT) -> DataFrame:
    """``(row_key, weather_score)`` of the forecast's hours, worked out once."""
    return cut_lineage(scores(forecast, config=config).select("row_key", "weather_score"))


def _scored(forecast: DataFrame, config: C.ScoringConfig) -> DataFrame:
    return forecast if "weather_score" in forecast.columns else hourly_scores(forecast, config)


def explained(
    forecast: DataFrame, hour: Column, config: C.ScoringConfig = C.DEFAULT
) -> DataFrame:
    return forecast.withColumn(
        "factors_used", WeatherFactors.of_forecast(config).explain(hour, config)
    )


def weather_at(
    instants: DataFrame,
    forecast: DataFrame,
    instant: str = "instant",
    config: C.ScoringConfig = C.DEFAULT,
    tz: str = "UTC",
) -> DataFrame:
    """Score of the forecast for the very hour of each instant, no fallback.

    ``forecast`` holds one row per hour key, or the ``hourly_scores`` made of them. Hours are few:
    they are reduced to their scores, counted and broadcast, so instants stay where they are
    and a busy hour is no matter. More hours than that are joined by a shuffle.
    """
    hourly = _scored(forecast, config).select(F.col("row_key").alias("hour_key"), "weather_score")
    hourly = small_side(hourly)
    return (
        instants.withColumn("hour_key", keys.hour_key(F.col(instant), tz))
        .join(hourly, "hour_key", "left")
        .withColumn("weather_found", F.col("weather_score").isNotNull())
    )


def scored_instants(
    forecast: DataFrame, step: str, config: C.ScoringConfig = C.DEFAULT, tz: str = "UTC"
) -> DataFrame:
    """The ``instant``s on the grid of ``step`` inside the forecast's hours with a score."""
    span = F.unix_seconds(F.timestamp_seconds(F.lit(0)) + F.expr(f"INTERVAL {step}"))
    begin = F.unix_seconds(keys.hour_start(F.col("row_key"), tz))
    late = begin + span - 1
    first, last = late - F.pmod(late, span), begin + 3599
    # A sequence that would begin behind its end is an error, so such hours have none.
    seconds = F.when(first <= last, F.sequence(first, last, span))
    scored = _scored(forecast, config).filter("weather_score IS NOT NULL")
    return (
        scored.select(F.explode(seconds).alias("second"))
        .select(F.timestamp_seconds("second").alias("instant"))
        .distinct()
    )


def with_air_quality(weather: DataFrame, air: DataFrame, how: str = "inner") -> DataFrame:
    """Weather and air quality of the same hour; both tables share their key."""
    extra = [name for name in air.columns if name not in weather.columns]
    return weather.join(air.select("row_key", *extra), "row_key", how)
