"""CSV export and the dated batch layer of the three feeds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citysignal import config as C
from citysignal.functions import sentiment


def export_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; quoting survives line breaks and quotes in text."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def import_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("escape", '"')
        .option("multiLine", True)
        .csv(path)
    )


def vehicles_layer(rows: DataFrame, acquired_on: Column) -> DataFrame:
    return rows.select(
        F.col("gps_time").alias("timestamp_utc"),
        F.col("lines").alias("linia"),
        F.col("vehicle_number").alias("pojazd_id"),
        "lat",
        "lon",
        acquired_on.alias("data_pozyskania"),
    )


def weather_layer(
    rows: DataFrame, acquired_on: Column, place: tuple[float, float] = C.SEARCH_CENTRE
) -> DataFrame:
    return rows.select(
        F.col("forecast_time").alias("timestamp_godzinowy"),
        F.lit(place[0]).alias("lat"),
        F.lit(place[1]).alias("lon"),
        F.col("temp_2m").alias("temperatura_2m"),
        F.col("rain").alias("deszcz"),
        F.col("cloud_cover").alias("zachmurzenie"),
        acquired_on.alias("data_pozyskania"),
    )


def tweets_layer(rows: DataFrame, acquired_on: Column) -> DataFrame:
    return rows.select(
        "tweet_id",
        "created_at",
        "author_name",
        "text",
        sentiment.is_negative(F.col("sentiment_score")).cast("int").alias("sentiment"),
        "hashtags",
        acquired_on.alias("data_pozyskania"),
    )


def write_layer(rows: DataFrame, root: str, source: str, format: str = "orc") -> str:
    """Write ``root/source/date=YYYY-MM-DD/`` and return the source folder.

    Rebalancing gathers each day into few files and splits a day that is too big.
    """
    path = f"{root}/{source}"
    dated = rows.withColumn("date", F.col("data_pozyskania")).hint("rebalance", "date")
    writer = dated.write.mode("overwrite").partitionBy("date").format(format)
    if format == "csv":
        writer = writer.option("header", True).option("escape", '"')
    writer.save(path)
    return path
