"""From raw messages to stored feeds, and from stored feeds to decisions.

The feeds meet only as keyed tables below one folder, so messages may be stored by streams,
by batches or by both, and decisions are made from whatever is current.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citysignal import config as C
from citysignal import schemas
from citysignal.functions import keys
from citysignal.operators import parse, sentiment, traffic
from citysignal.operators.store import KeyedTable
from citysignal.plans.decisions import decision_plan

# How the rows of a feed's table are ordered: by the arrival of their message.
ARRIVED = "arrived"


def tables(spark: SparkSession, root: str) -> dict[str, KeyedTable]:
    return {
        feed: KeyedTable(spark, f"{root}/{feed}", order=[ARRIVED])
        for feed in ("vehicles", "tweets", "weather")
    }


def vehicle_rows(messages: DataFrame, kind: str = "bus", tz: str = "UTC") -> DataFrame:
    """Usable vehicle reports; works on streams too."""
    parsed = parse.parse_vehicles(messages, kind, ingested_at=F.col("kafka_ts"), tz=tz)
    good, _ = parse.quarantine_vehicles(parsed)
    return good.withColumn(ARRIVED, F.unix_micros("ingestion_timestamp"))


def tweet_rows(messages: DataFrame, lexicon: DataFrame, tz: str = "UTC") -> DataFrame:
    """Messages with their score; works on streams too."""
    arrived = F.unix_micros("kafka_ts").alias(ARRIVED)
    good, _ = parse.quarantine_keyed(parse.parse_tweets(messages, tz=tz, keep=[arrived]))
    return sentiment.bucketed(sentiment.score_rows(good, lexicon))


def weather_rows(messages: DataFrame) -> DataFrame:
    good, _ = parse.quarantine_keyed(parse.parse_hourly(messages, schemas.WEATHER))
    return good.withColumn(ARRIVED, F.unix_micros("kafka_ts")).drop("kafka_ts")


def store_feeds(
    root: str,
    *,
    vehicles: DataFrame,
    tweets: DataFrame,
    weather: DataFrame,
    lexicon: DataFrame,
    batch_id: int = 0,
    tz: str = "UTC",
) -> dict[str, KeyedTable]:
    """Parse a batch of each feed's messages into its table; a repeated batch replaces itself."""
    stored = tables(vehicles.sparkSession, root)
    stored["vehicles"].upsert(vehicle_rows(vehicles, tz=tz), batch_id)
    stored["tweets"].upsert(tweet_rows(tweets, lexicon, tz), batch_id)
    stored["weather"].upsert(weather_rows(weather), batch_id)
    return stored


def decide_stored(
    spark: SparkSession,
    root: str,
    config: C.ScoringConfig = C.DEFAULT,
    *,
    length: str | None = None,
    tz: str = "UTC",
) -> DataFrame:
    """Decisions from the current rows of the feeds' tables.

    Of vehicles and messages only numbers and times are read beside the key, which holds the vehicle.
    """
    stored = tables(spark, root)
    at = F.try_to_timestamp("gps_time", F.lit(keys.CLOCK_TIME)).alias("at")
    seen = stored["vehicles"].latest(at, "lat", "lon")
    seen = seen.withColumn("vehicle_number", keys.key_vehicle(F.col("row_key")))
    reports = traffic.positions(seen, vehicle="vehicle_number", ts="at", seq=ARRIVED)
    tweets = stored["tweets"].latest("sentiment_score")
    tweets = tweets.select(F.timestamp_micros(ARRIVED).alias("ts"), "sentiment_score")
    return decision_plan(reports, tweets, stored["weather"].latest(), config, length=length, tz=tz)
