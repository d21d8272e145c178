"""Windowed scores on streams: the batch operators behind a watermark."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citysignal import config as C
from citysignal.operators import combine, sentiment, traffic, weather

LATENESS = "10 minutes"
NOT_BEGUN = "1970-01-01T00:00:00.000Z"


def stream_traffic(
    reports: DataFrame,
    length: str | None = None,
    lateness: str = LATENESS,
    config: C.ScoringConfig = C.DEFAULT,
) -> DataFrame:
    """Traffic score per closed window; state is one row per vehicle and window."""
    timely = reports.withWatermark("ts", lateness)
    if length:
        return traffic.tumbling_traffic(timely, length, config)
    return traffic.sliding_traffic(timely, config)


def stream_speeds(
    reports: DataFrame,
    length: str | None = None,
    lateness: str = LATENESS,
    config: C.ScoringConfig = C.DEFAULT,
) -> DataFrame:
    """Speed per vehicle and closed window; the input of ``plans.decide_windows``."""
    timely = reports.withWatermark("ts", lateness)
    if length:
        ends = traffic.sightings(timely, length)
    else:
        ends = traffic.sliding_sightings(timely, config.window, config.slide)
    return traffic.speeds(ends, config)


def stream_steps(
    reports: DataFrame, lateness: str = LATENESS, config: C.ScoringConfig = C.DEFAULT
) -> DataFrame:
    """First and last report per vehicle and closed slide step; the input of ``sliding_traffic_of``.

    State is one row per vehicle and step, where ``stream_traffic`` keeps one for every sliding
    window over it as well.
    """
    return traffic.sightings(reports.withWatermark("ts", lateness), config.slide)


def sliding_traffic_of(
    steps: DataFrame, until: str | None, config: C.ScoringConfig = C.DEFAULT
) -> DataFrame:
    """Traffic score of the sliding windows that are closed, from the table of closed steps, in batch.

    ``until`` is the watermark of the stream that wrote the steps: a window is closed once its last
    step is. The rows are those that ``stream_traffic`` emits.
    """
    ends = traffic.sliding_ends(steps, config.window, config.slide)
    closed = ends.filter(F.col("window.end") <= F.lit(until).cast("timestamp"))
    return traffic.traffic_scores(traffic.speeds(closed, config))


# Windows are reduced in this many parts by vehicle before they are put together.
LANES = 64


def stream_scores_with_targets(
    moving: DataFrame, config: C.ScoringConfig = C.DEFAULT, lanes: int = LANES
) -> DataFrame:
    """``(window, vehicles, congested, traffic_score, targets)`` as chained aggregates of a stream.

    Ranks need a sort that streams do not have, so each lane of vehicles keeps its slowest few, and a
    window puts the lanes' few together: a group holds the congested vehicles of one lane.
    """
    slow = F.when(F.col("congested"), F.struct("speed_kmh", "first_ts", "vn"))
    few = lambda listed: F.slice(F.array_sort(listed), 1, config.targets_per_decision)
    lane = F.pmod(F.xxhash64("vn"), F.lit(lanes)).alias("lane")
    by_lane = moving.groupBy("window", lane).agg(
        F.count("*").alias("vehicles"),
        F.count_if(F.col("congested")).alias("congested"),
        few(F.collect_list(slow)).alias("few"),
    )
    whole = by_lane.groupBy("window").agg(
        F.sum("vehicles").alias("vehicles"),
        F.sum("congested").alias("congested"),
        few(F.flatten(F.collect_list("few"))).alias("few"),
    )
    share = (F.col("congested") / F.col("vehicles")).cast("double")
    return whole.select(
        "window",
        "vehicles",
        "congested",
        F.least(share, F.lit(1.0)).alias("traffic_score"),
        F.transform("few", lambda t: t["vn"]).alias("targets"),
    )


def stream_decisions(
    reports: DataFrame,
    tweets: DataFrame,
    forecast: DataFrame,
    length: str | None = None,
    lateness: str | None = LATENESS,
    config: C.ScoringConfig = C.DEFAULT,
    tz: str = "UTC",
) -> DataFrame:
    """Decisions of two streams in one query: vehicles by window, windows, and a full outer join.

    A window is decided once the watermarks of both streams have passed it; one that only one of
    them has rows for counts the other as zero. ``lateness=None`` says that the streams carry
    watermarks already: set them before filters, then a stream whose rows are all filtered out
    still lets time pass. ``forecast`` is a table with the latest row of each hour. Windows with a
    forecast but neither vehicles nor messages are no rows of a stream; ``plans.decide_windows`` adds them
    in batch.
    """
    if lateness:
        reports, tweets = (rows.withWatermark("ts", lateness) for rows in (reports, tweets))
    if length:
        ends = traffic.sightings(reports, length)
        negative = sentiment.negative_share(tweets, length)
    else:
        ends = traffic.sliding_sightings(reports, config.window, config.slide)
        negative = sentiment.negative_share(tweets, config.window, config.slide)
    driving = stream_scores_with_targets(traffic.speeds(ends, config), config)
    joined = driving.select("window", "traffic_score", "targets").join(
        negative.select("window", F.col("sentiment_ratio").alias("sentiment_score")), "window", "full"
    )
    instants = joined.select(F.col("window.end").alias("instant"), *joined.columns[1:])
    weathered = weather.weather_at(instants, forecast, config=config, tz=tz).drop("weather_found")
    return combine.decide(combine.fill_signals(weathered), config, tz=tz)


def decidable(
    moving: DataFrame, negative: DataFrame, until: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Cut both emitted tables to the windows that are final in either stream.

    The streams advance on their own; a window that only one of them has passed
    waits for the other. ``until`` is the lower of the streams' watermarks
    (``earliest``): a stream that emits nothing then holds nothing back. Without it
    the last emitted windows stand for the watermarks.
    """
    if until is None:
        ends = [df.agg(F.max("window.end").alias("end")) for df in (moving, negative)]
        both = F.when(F.count("end") == 2, F.min("end"))
        until = ends[0].unionAll(ends[1]).agg(both).first()[0]
    final = F.col("window.end") <= F.lit(until).cast("timestamp")
    return moving.filter(final), negative.filter(final)


def earliest(watermarks: Sequence[str | None]) -> str:
    """The lowest of several streams' watermarks; a stream without one has not begun."""
    return min(mark or NOT_BEGUN for mark in watermarks)


def stream_negative_share(
    tweets: DataFrame, length: str, slide: str | None = None, lateness: str = LATENESS
) -> DataFrame:
    return sentiment.negative_share(tweets.withWatermark("ts", lateness), length, slide)


def stream_rain_congestion(
    reports: DataFrame,
    rain: DataFrame,
    length: str,
    lateness: str = LATENESS,
    config: C.ScoringConfig = C.DEFAULT,
) -> DataFrame:
    """Join of two watermarked streams on their window.

    ``rain`` holds forecast rows ``(ts, rain)``; its window keeps the most rain.
    """
    wet = (
        rain.withWatermark("ts", lateness)
        .groupBy(F.window("ts", length).alias("window"))
        .agg(F.max("rain").alias("rain"))
    )
    return combine.rain_with_congestion(wet, stream_traffic(reports, length, lateness, config))


def run_to_files(df: DataFrame, path: str, checkpoint: str) -> str | None:
    """Work off everything available into a Parquet folder (append mode).

    Returns the watermark of the last batch, up to which windows are final; None where no
    batch ran or the stream has no watermark.
    """
    query = (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )
    query.awaitTermination()
    progress = query.lastProgress
    return progress["eventTime"].get("watermark") if progress else None


def late_rows(
    counted: DataFrame, raw: DataFrame, length: str, ts: str = "ts", until: str | None = None
) -> DataFrame:
    """Rows per closed window that came too late to be counted.

    ``counted`` is what the stream emitted, ``(window, n)``; ``raw`` everything
    that arrived; ``until`` the watermark that the stream reached, by default the end of
    its last emitted window. A window all of whose rows were late has none on time.
    """
    if until is None:
        until = counted.agg(F.max("window.end")).first()[0]
    arrived = raw.groupBy(F.window(ts, length).alias("window")).agg(F.count("*").alias("arrived"))
    on_time = F.coalesce("n", F.lit(0).cast("bigint"))
    return (
        arrived.filter(F.col("window.end") <= F.lit(until).cast("timestamp"))
        .join(counted, "window", "left")
        .select("window", on_time.alias("on_time"), (F.col("arrived") - on_time).alias("late"))
    )
