"""Raw messages to typed rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citysignal import schemas
from citysignal.functions import keys, text


def _stamp(ingested_at: str | Column | None) -> Column:
    """Processing time, or a given instant so that a run can be repeated exactly."""
    if ingested_at is None:
        return F.current_timestamp()
    return F.lit(ingested_at).cast("timestamp") if isinstance(ingested_at, str) else ingested_at


def vehicle_bodies(messages: DataFrame) -> DataFrame:
    return messages.withColumn("body", F.from_json("json", schemas.VEHICLES_JSON))


def parse_vehicles(
    messages: DataFrame,
    vehicle_type: str | Column,
    *,
    event_time: str = "gps",
    ingested_at: str | Column | None = None,
    tz: str = "UTC",
) -> DataFrame:
    """One row per reported vehicle.

    ``event_time`` picks what the row key is cut from: the time the vehicle
    reported (``gps``), the message arrival (``arrival``) or the time of
    processing (``processing``).
    """
    opened = vehicle_bodies(messages).select(F.explode("body.result").alias("v"), "kafka_ts")
    columns = _vehicle_columns(vehicle_type, event_time, _stamp(ingested_at), tz)
    return opened.select(*columns)


def _vehicle_columns(
    vehicle_type: str | Column, event_time: str, ingested: Column, tz: str
) -> list[Column]:
    kind = F.lit(vehicle_type) if isinstance(vehicle_type, str) else vehicle_type
    instant = {
        "gps": F.try_to_timestamp(F.col("v.Time"), F.lit(keys.CLOCK_TIME)),
        "arrival": F.col("kafka_ts"),
        "processing": ingested,
    }[event_time]
    # Only GPS times are already wall-clock strings; the others are instants.
    zone = "UTC" if event_time == "gps" else tz
    return [
        keys.vehicle_key(instant, F.col("v.VehicleNumber"), zone).alias("row_key"),
        F.col("v.Lines").alias("lines"),
        F.col("v.VehicleNumber").alias("vehicle_number"),
        F.col("v.Brigade").alias("brigade"),
        F.col("v.Time").alias("gps_time"),
        F.col("v.Lat").alias("lat"),
        F.col("v.Lon").alias("lon"),
        kind.alias("vehicle_type"),
        ingested.alias("ingestion_timestamp"),
    ]


def judged_vehicles(
    messages: DataFrame,
    vehicle_type: str | Column,
    *,
    event_time: str = "gps",
    ingested_at: str | Column | None = None,
    tz: str = "UTC",
) -> DataFrame:
    """Vehicle rows and unreadable messages in one pass over the messages.

    ``reason`` is null for accepted rows; an unreadable message comes as one row
    that keeps its ``json`` and has no vehicle columns.
    """
    opened = (
        vehicle_bodies(messages)
        .filter(F.coalesce(F.size("body.result") > 0, F.lit(True)))
        .select("json", "kafka_ts", F.explode_outer("body.result").alias("v"), "body")
        .withColumn("readable", F.col("body.result").isNotNull())
    )
    columns = _vehicle_columns(vehicle_type, event_time, _stamp(ingested_at), tz)
    rows = opened.select(
        "kafka_ts", "readable", F.when(~F.col("readable"), F.col("json")).alias("json"), *columns
    )
    checks = {"unreadable": F.col("readable"), **_vehicle_checks()}
    return _judged(rows, checks).drop("readable")


def union_feeds(*feeds: DataFrame) -> DataFrame:
    """Vehicle feeds of all kinds as one table."""
    merged = feeds[0]
    for feed in feeds[1:]:
        merged = merged.unionByName(feed)
    return merged


def zip_hourly(
    messages: DataFrame, feed: schemas.HourlyFeed, *, strict: bool = False
) -> DataFrame:
    """One row per forecast hour from a message of parallel arrays.

    A measure that a message leaves out is padded with nulls. ``strict`` keeps
    the behaviour of a plain zip: one absent array drops the whole message.
    """
    hourly = F.from_json("json", feed.json_schema)["hourly"]
    opened = messages.withColumn("hourly", hourly)

    def measure(field: str, kind: str) -> Column:
        values = F.col(f"hourly.{field}")
        if not strict:
            gap = F.array_repeat(F.lit(None).cast(kind), F.size("hourly.time"))
            values = F.coalesce(values, gap)
        return values.alias(field)

    arrays = [F.col("hourly.time").alias("time")]
    arrays += [measure(field, kind) for field, _, kind in feed.measures]
    return opened.select("kafka_ts", *arrays).select(
        "kafka_ts",
        F.explode(F.arrays_zip("time", *[field for field, _, _ in feed.measures])).alias("hour"),
    )


def parse_hourly(
    messages: DataFrame,
    feed: schemas.HourlyFeed,
    *,
    strict: bool = False,
    ingested_at: str | Column | None = None,
) -> DataFrame:
    """Forecast table rows keyed by the forecast hour."""
    return zip_hourly(messages, feed, strict=strict).select(
        keys.forecast_key(F.col("hour.time")).alias("row_key"),
        *[F.col(f"hour.{field}").alias(column) for field, column, _ in feed.measures],
        _stamp(ingested_at).alias("ingestion_timestamp"),
        F.col("hour.time").alias("forecast_time"),
        "kafka_ts",
    )


def parse_tweets(
    messages: DataFrame,
    *,
    ingested_at: str | Column | None = None,
    tz: str = "UTC",
    keep: Sequence[Column] = (),
) -> DataFrame:
    """One row per message post, keyed by arrival second and post id.

    ``keep`` adds columns made of the message, such as its arrival.
    """
    body = F.from_json("json", schemas.TWEETS_JSON)
    posts = (
        messages.select(body["tweets"].alias("tweets"), "kafka_ts")
        .filter(F.col("tweets").isNotNull())
        .select(F.explode("tweets").alias("t"), "kafka_ts")
    )
    processed = F.date_format(keys.wall_clock(_stamp(ingested_at), tz), keys.CLOCK_TIME)
    return posts.select(
        keys.tweet_key(F.col("kafka_ts"), F.col("t.id"), tz).alias("row_key"),
        F.col("t.id").alias("tweet_id"),
        F.col("t.createdAt").alias("created_at"),
        F.col("t.author.name").alias("author_name"),
        F.col("t.author.userName").alias("username"),
        F.col("t.text").alias("text"),
        text.joined_hashtags(F.col("t.entities.hashtags")).alias("hashtags"),
        F.col("t.likeCount").alias("like_count"),
        F.col("t.retweetCount").alias("retweet_count"),
        F.col("t.replyCount").alias("reply_count"),
        F.col("t.viewCount").alias("view_count"),
        F.col("t.lang").alias("lang"),
        F.date_format(keys.wall_clock(F.col("kafka_ts"), tz), "yyyy-MM-dd").alias(
            "data_acquisition_date"
        ),
        processed.alias("ingestion_timestamp"),
        processed.alias("analysis_timestamp"),
        *keep,
    )


def normalize_tweets(messages: DataFrame, *, acquired_on: str | Column) -> DataFrame:
    """Posts of either API version reduced to one set of columns."""
    posts = messages.select(
        F.explode(F.from_json("json", schemas.TWEETS_ANY_JSON)["tweets"]).alias("t")
    )
    author = F.coalesce(F.col("t.author"), F.col("t.user"))
    empty = F.lit("")
    day = F.lit(acquired_on) if isinstance(acquired_on, str) else acquired_on
    return posts.select(
        F.coalesce(text.first_filled(F.col("t.id"), F.col("t.id_str")), empty).alias("tweet_id"),
        F.coalesce(
            text.first_filled(F.col("t.createdAt"), F.col("t.created_at")), empty
        ).alias("created_at"),
        F.coalesce(
            text.first_filled(author["name"], author["userName"], author["screen_name"]),
            F.lit("Unknown"),
        ).alias("author_name"),
        F.coalesce(text.first_filled(F.col("t.text"), F.col("t.full_text")), empty).alias("text"),
        text.joined_hashtags(F.col("t.entities.hashtags"), prefix="#").alias("hashtags"),
        F.date_format(day.cast("timestamp"), "yyyy-MM-dd").alias("data_acquisition_date"),
    )


def _judged(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    failed = [
        F.when(F.coalesce(condition, F.lit(False)), F.lit(None)).otherwise(F.lit(reason))
        for reason, condition in checks.items()
    ]
    return df.withColumn("reason", F.coalesce(*failed))


def quarantine(
    df: DataFrame, checks: Mapping[str, Column]
) -> tuple[DataFrame, DataFrame]:
    """Split rows into accepted and rejected.

    ``checks`` maps a reason to the condition a good row fulfils; a rejected row
    carries the first reason that applies. A null condition counts as failed.
    """
    judged = _judged(df, checks)
    good = judged.filter(F.col("reason").isNull()).drop("reason")
    return good, judged.filter(F.col("reason").isNotNull())


def quarantine_messages(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Vehicle messages without a readable vehicle list are set aside."""
    good, bad = quarantine(
        vehicle_bodies(messages), {"unreadable": F.col("body.result").isNotNull()}
    )
    return good.drop("body"), bad.drop("body")


def _vehicle_checks() -> dict[str, Column]:
    return {
        "no_vehicle": F.col("vehicle_number") != "",
        "bad_time": F.try_to_timestamp(F.col("gps_time"), F.lit(keys.CLOCK_TIME)).isNotNull(),
        "no_position": F.col("lat").isNotNull() & F.col("lon").isNotNull(),
    }


def quarantine_vehicles(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    return quarantine(rows, _vehicle_checks())


def quarantine_keyed(rows: DataFrame, key: str = "row_key") -> tuple[DataFrame, DataFrame]:
    """Rows whose key could not be built must not stop the batch."""
    return quarantine(rows, {"no_key": F.col(key).isNotNull()})
