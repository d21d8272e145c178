"""Raw feed messages: one JSON document per row plus its arrival time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FILE_SCHEMA = "value STRING, timestamp TIMESTAMP"


def envelopes(raw: DataFrame) -> DataFrame:
    """``(json, kafka_ts)`` of rows shaped like a Kafka record (``value``, ``timestamp``)."""
    return raw.select(
        F.col("value").cast("string").alias("json"),
        F.col("timestamp").cast("timestamp").alias("kafka_ts"),
    )


def read_envelopes(
    spark: SparkSession,
    topic: str,
    *,
    format: str = "kafka",
    servers: str | None = None,
    starting: str = "earliest",
    fail_on_data_loss: bool = False,
    streaming: bool = True,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Messages of a topic; with a file format, ``topic`` is a folder of such records."""
    reader = spark.readStream if streaming else spark.read
    reader = reader.format(format)
    if format == "kafka":
        reader = (
            reader.option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic)
            .option("startingOffsets", starting)
            .option("failOnDataLoss", str(fail_on_data_loss).lower())
        )
        source = None
    else:
        reader = reader.schema(FILE_SCHEMA)
        source = topic
    for key, value in (options or {}).items():
        reader = reader.option(key, value)
    return envelopes(reader.load(source) if source else reader.load())


def read_table_stream(
    spark: SparkSession, path: str, schema, *, max_files: int | None = None
) -> DataFrame:
    """Stream a Parquet table that may be a single file or a folder of files.

    The last character is written as a one-letter glob: a file stream accepts a
    pattern for either shape, but a literal path only for a folder.
    """
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(f"{path[:-1]}[{path[-1]}]")


# Costly rows that one task is dealt at most.
ROWS_A_TASK = 100_000


def spread(df: DataFrame, rows: int = ROWS_A_TASK) -> DataFrame:
    """Deal rows out to all cores, in tasks of at most about ``rows``.

    For batch reads ahead of costly per-row work, where a handful of files would
    otherwise keep most of the cluster idle. Splits are cut by bytes, but a Parquet row group
    is read whole by one of them, and tables of numbers have many rows a byte: so the rows of
    each split are counted, which reads no columns. A source whose splits are many and even
    enough is returned as it is, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    counted = df.groupBy(F.spark_partition_id().alias("split")).count()
    most, total = counted.agg(F.max("count"), F.sum("count")).first()
    wanted = max(cores, -(-(total or 0) // rows))
    # No split may hold more than two tasks' share.
    if df.rdd.getNumPartitions() >= cores and (most or 0) * wanted <= 2 * (total or 0):
        return df
    return df.repartition(wanted)
