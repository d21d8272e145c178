"""Deterministic sample decisions for demonstrations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citysignal import config as C
from citysignal.functions import decision, keys


def uniform(number: Column, salt: str) -> Column:
    """Repeatable value in [0, 1) per number and salt: 32 bits of an MD5 digest."""
    digest = F.md5(F.concat(F.lit(salt), F.lit(":"), number.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(float(2**32))


def sample_decisions_for(
    numbered: DataFrame,
    number: str,
    config: C.ScoringConfig = C.DOCUMENTED,
    start: str = "2024-01-01 00:00:00",
) -> DataFrame:
    """One sample decision per row of ``numbered``, a second apart from ``start``."""
    scored = numbered.select(
        F.col(number).cast("bigint").alias("n"),
        *[
            uniform(F.col(number), part).alias(f"{part}_score")
            for part in ("traffic", "weather", "sentiment")
        ],
    ).withColumn(
        "global_score",
        decision.global_score(
            F.col("traffic_score"), F.col("weather_score"), F.col("sentiment_score"), config
        ),
    )
    at = F.timestamp_seconds(F.unix_timestamp(F.lit(start).cast("timestamp")) + F.col("n"))
    return scored.select(
        F.concat_ws("_", keys.second_key(at), F.col("n")).alias("decision_id"),
        "traffic_score",
        "weather_score",
        "sentiment_score",
        "global_score",
        decision.result(F.col("global_score"), config).alias("decision_result"),
        F.lit("[]").alias("target_locations"),
        F.date_format(at, keys.CLOCK_TIME).alias("decision_time"),
    )


def sample_decisions(spark: SparkSession, n: int = 100, **options) -> DataFrame:
    return sample_decisions_for(spark.range(n), "id", **options)
