"""Schemas of the raw feeds and of the stored tables, as Spark DDL."""

from __future__ import annotations

from dataclasses import dataclass

VEHICLES_JSON = """
    result ARRAY<STRUCT<
        Lines: STRING, Lon: DOUBLE, VehicleNumber: STRING,
        Time: STRING, Lat: DOUBLE, Brigade: STRING>>
"""

_HASHTAGS = "STRUCT<hashtags: ARRAY<STRUCT<text: STRING, indices: ARRAY<INT>>>>"

# View counts overflow INT on popular messages, hence BIGINT engagement.
TWEETS_JSON = f"""
    tweets ARRAY<STRUCT<
        id: STRING, text: STRING, createdAt: STRING,
        author: STRUCT<userName: STRING, name: STRING, id: STRING>,
        entities: {_HASHTAGS},
        lang: STRING, likeCount: BIGINT, retweetCount: BIGINT,
        replyCount: BIGINT, viewCount: BIGINT>>
"""

_ANY_AUTHOR = "STRUCT<userName: STRING, name: STRING, screen_name: STRING, id: STRING>"

# Same message, accepting the alternative field names other API versions use.
TWEETS_ANY_JSON = f"""
    tweets ARRAY<STRUCT<
        id: STRING, id_str: STRING, text: STRING, full_text: STRING,
        createdAt: STRING, created_at: STRING,
        author: {_ANY_AUTHOR}, user: {_ANY_AUTHOR},
        entities: {_HASHTAGS}>>
"""


@dataclass(frozen=True)
class HourlyFeed:
    """A forecast feed that ships one array per measure, aligned by position.

    ``measures`` lists ``(field in the message, column in the table, type)``.
    """

    name: str
    measures: tuple[tuple[str, str, str], ...]

    @property
    def json_schema(self) -> str:
        arrays = ", ".join(f"{field}: ARRAY<{kind}>" for field, _, kind in self.measures)
        return f"hourly STRUCT<time: ARRAY<STRING>, {arrays}>"

    @property
    def columns(self) -> list[str]:
        return [column for _, column, _ in self.measures]


WEATHER = HourlyFeed(
    "weather",
    (
        ("temperature_2m", "temp_2m", "DOUBLE"),
        ("apparent_temperature", "apparent_temp", "DOUBLE"),
        ("precipitation_probability", "precip_probability", "INT"),
        ("precipitation", "precip_total", "DOUBLE"),
        ("rain", "rain", "DOUBLE"),
        ("snowfall", "snowfall", "DOUBLE"),
        ("snow_depth", "snow_depth", "DOUBLE"),
        ("weather_code", "weather_code", "INT"),
        ("cloud_cover", "cloud_cover", "INT"),
        ("relative_humidity_2m", "relative_humidity", "INT"),
        ("wind_speed_10m", "wind_speed", "DOUBLE"),
        ("wind_gusts_10m", "wind_gusts", "DOUBLE"),
    ),
)

AIR_QUALITY = HourlyFeed(
    "air_quality",
    tuple(
        (name, name, "DOUBLE")
        for name in (
            "pm10",
            "pm2_5",
            "ozone",
            "nitrogen_dioxide",
            "sulphur_dioxide",
            "ammonia",
            "uv_index",
            "uv_index_clear_sky",
            "alder_pollen",
            "birch_pollen",
            "grass_pollen",
            "mugwort_pollen",
            "ragweed_pollen",
        )
    ),
)

ARCHIVE_COLUMNS = """
    decision_id STRING, traffic_score DOUBLE, weather_score DOUBLE,
    sentiment_score DOUBLE, global_score DOUBLE, decision_result STRING,
    target_locations STRING, decision_time STRING, display_time STRING
"""
# The stored table also keeps the campaign; the nine columns are a view of it.
ARCHIVE_BASE_COLUMNS = f"{ARCHIVE_COLUMNS.rstrip()}, campaign_type STRING"
ARCHIVE_PARTITIONS = ("dt", "hr")

SCORES = ("traffic_score", "weather_score", "sentiment_score", "global_score")

DECISION_PAYLOAD_JSON = """
    decision_id STRING, timestamp STRING, display_time STRING, decision STRING,
    metrics STRUCT<global: DOUBLE, traffic: DOUBLE, weather: DOUBLE, sentiment: DOUBLE>,
    action STRUCT<show_ad: BOOLEAN, campaign: STRING, targets: ARRAY<STRING>>
"""
