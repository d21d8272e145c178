"""The whole decision: three feeds in, decisions out, one logical plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citysignal import config as C
from citysignal.operators import combine, sentiment, traffic, weather


def decision_plan(
    reports: DataFrame,
    tweets: DataFrame,
    forecast: DataFrame,
    config: C.ScoringConfig = C.DEFAULT,
    *,
    length: str | None = None,
    tz: str = "UTC",
) -> DataFrame:
    """Decisions at the end of every window for which any one source has data.

    Where only the forecast has data, windows end on the same grid within its hours.

    ``reports``  vehicle positions (``traffic.positions``)
    ``tweets``   rows ``(ts, sentiment_score)``
    ``forecast`` latest forecast row per hour key
    ``length``   tumbling window; the sliding window of ``config`` by default
    """
    if length:
        ends = traffic.sightings(reports, length)
        negative = sentiment.negative_share(tweets, length)
    else:
        ends = traffic.sliding_sightings(reports, config.window, config.slide)
        negative = sentiment.negative_share(tweets, config.window, config.slide)
    return decide_windows(
        traffic.speeds(ends, config), negative, forecast, config, tz=tz, step=length or config.slide
    )


def decide_windows(
    moving: DataFrame,
    negative: DataFrame,
    forecast: DataFrame,
    config: C.ScoringConfig = C.DEFAULT,
    *,
    tz: str = "UTC",
    step: str | None = None,
    until: str | None = None,
) -> DataFrame:
    """Decisions from vehicle speeds and negative shares that are final per window.

    With ``step``, the distance of window ends, also at those ends that lie in hours with
    a weather score but have neither vehicles nor messages; ``until`` leaves out later ends.
    """
    instant = F.col("window.end").alias("instant")
    hourly = weather.hourly_scores(forecast, config)
    driving = traffic.scores_with_targets(moving, config)
    by_traffic = driving.select(instant, "traffic_score", "targets")
    by_mood = negative.select(instant, F.col("sentiment_ratio").alias("sentiment_score"))

    instants = by_traffic.join(by_mood, "instant", "full")
    if step:
        instants = instants.join(weather.scored_instants(hourly, step, config, tz=tz), "instant", "full")
    if until:
        instants = instants.filter(F.col("instant") <= F.lit(until).cast("timestamp"))
    weathered = weather.weather_at(instants, hourly, config=config, tz=tz).drop("weather_found")
    return combine.decide(combine.fill_signals(weathered), config, tz=tz)
