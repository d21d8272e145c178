"""Congestion from vehicle movement.

Positions are rows ``(vn, ts, lat, lon, seq)``. A report overwrites an earlier
one of the same vehicle and second when its ``seq`` is higher, as in a keyed
store; a null ``seq`` is lower than any other. The first and the last report of a
window are picked by one number that packs the second within the window and the
write sequence: it is unique per report, so latitude and longitude always come
from the same row, and being a plain number it keeps the aggregation in the hash
aggregate, with partial results merged before the shuffle however many rows one
vehicle has. Windows may have any length and ``seq`` any BIGINT.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citysignal import config as C
from citysignal.functions.geo import haversine_km
from citysignal.operators import packed


def positions(
    rows: DataFrame, *, vehicle: str, ts: str, lat: str = "lat", lon: str = "lon", seq: str
) -> DataFrame:
    """Bring a table into the ``(vn, ts, lat, lon, seq)`` shape."""
    return rows.select(
        F.col(vehicle).alias("vn"),
        F.col(ts).cast("timestamp").alias("ts"),
        F.col(lat).alias("lat"),
        F.col(lon).alias("lon"),
        F.col(seq).cast("bigint").alias("seq"),
    )


def _seconds_since(origin: Column, ts: Column) -> Column:
    return F.unix_seconds(ts) - F.unix_seconds(origin)


def _ends(first: str, last: str, lat_lon_first: tuple[str, str], lat_lon_last: tuple[str, str]):
    return [
        F.min_by(lat_lon_first[0], first).alias("first_lat"),
        F.min_by(lat_lon_first[1], first).alias("first_lon"),
        F.max_by(lat_lon_last[0], last).alias("last_lat"),
        F.max_by(lat_lon_last[1], last).alias("last_lon"),
        F.min(first).alias("first_order"),
        F.max(last).alias("last_order"),
    ]


def sightings(reports: DataFrame, length: str) -> DataFrame:
    """First and last report per vehicle and tumbling window.

    A report without a position still makes its vehicle count as seen.
    """
    located = F.col("lat").isNotNull() & F.col("lon").isNotNull()
    placed = reports.withColumn("window", F.window("ts", length))
    second = _seconds_since(F.col("window.start"), F.col("ts"))
    ranked = placed.withColumn(
        "last", F.when(located, packed.pack(second, F.col("seq")))
    ).withColumn(
        # Within a second the later write wins, so it must also come first.
        "first", F.when(located, packed.pack_descending(second, F.col("seq")))
    )
    return ranked.groupBy("window", "vn").agg(
        *_ends("first", "last", ("lat", "lon"), ("lat", "lon")), F.count("*").alias("reports")
    )


def sliding_sightings(reports: DataFrame, length: str, slide: str) -> DataFrame:
    """First and last report per vehicle and sliding window.

    Reports are reduced once per slide step, and only those reduced rows are
    copied into the overlapping windows. ``length`` must be a multiple of
    ``slide``.

    In batch the steps are placed by vehicle, and each looks back over the steps before it: a
    window comes from the last step it holds, once and whole. The copies are neither shuffled nor
    aggregated, sorted or kept, so they cost no memory or disk. By then a vehicle has one row per
    step at most, whatever it sent. Ends come as seconds of the window, ``first_second`` and
    ``last_second``, in place of packed orders.
    """
    steps = sightings(reports, slide)
    if not reports.isStreaming:
        return sliding_ends(steps, length, slide)
    _span_and_step(reports, length, slide)
    steps = steps.withColumnRenamed("window", "step")
    # Only the built-in window keeps the watermark.
    copied = steps.withColumn("window", F.window(F.window_time("step"), length, slide))
    spread = (
        copied.withColumn("shift", _seconds_since(F.col("window.start"), F.col("step.start")))
        .withColumn("shift", packed.raised(F.col("shift")))
        .withColumn("first", (F.col("first_order") + F.col("shift")).cast(packed.PACKED))
        .withColumn("last", (F.col("last_order") + F.col("shift")).cast(packed.PACKED))
    )
    return spread.groupBy("window", "vn").agg(
        *_ends("first", "last", ("first_lat", "first_lon"), ("last_lat", "last_lon")),
        F.sum("reports").alias("reports"),
    )


def _span_and_step(rows: DataFrame, length: str, slide: str) -> tuple[int, int]:
    """Both in microseconds."""
    micros = [F.expr(f"unix_micros(timestamp_micros(0) + INTERVAL {i})") for i in (length, slide)]
    span, every = rows.sparkSession.range(1).select(*micros).first()
    if span % every:
        raise ValueError(f"the window ({length}) must be a multiple of the slide ({slide})")
    return span, every


def sliding_ends(steps: DataFrame, length: str, slide: str) -> DataFrame:
    """First and last report per vehicle and sliding window, in batch, from its ``sightings`` per slide step."""
    span, every = _span_and_step(steps, length, slide)
    return _looking_back(steps.withColumnRenamed("window", "step").repartition("vn"), span, every)


def _looking_back(steps: DataFrame, span: int, every: int) -> DataFrame:
    """Ends of all sliding windows, of ``span`` microseconds each, from a vehicle's steps.

    A step is the last one of the windows that hold it and end before the vehicle's next step does.
    """
    timed = steps.select(
        "vn",
        F.unix_micros("step.start").alias("at"),
        *[
            (F.unix_seconds("step.start") + packed.high_of(F.col(f"{end}_order"))).alias(end)
            for end in ("first", "last")
        ],
        *["first_lat", "first_lon", "last_lat", "last_lon", "reports"],
    )
    track = Window.partitionBy("vn").orderBy("at")
    back = track.rangeBetween(every - span, Window.currentRow)
    step = F.struct(*[name for name in timed.columns if name != "vn"])
    recent = timed.select(
        "vn", "at", F.lead("at").over(track).alias("next"), F.collect_list(step).over(back).alias("steps")
    )
    # The next step is null behind the last one, and ``least`` passes over it.
    latest = F.least(F.col("at"), F.col("next") - span)
    starts = F.sequence(F.col("at") + (every - span), latest, F.lit(every))
    held = recent.select("vn", "steps", F.explode(starts).alias("start")).select(
        "vn",
        "start",
        F.filter("steps", lambda step: step["at"] >= F.col("start")).alias("held"),
    )
    located = F.filter("held", lambda step: step["first"].isNotNull())
    ends = held.withColumn("located", located).select(
        F.struct(
            F.timestamp_micros("start").alias("start"), F.timestamp_micros(F.col("start") + span).alias("end")
        ).alias("window"),
        "vn",
        F.get("located", 0).alias("a"),
        F.get("located", F.size("located") - 1).alias("z"),
        F.aggregate("held", F.lit(0).cast("bigint"), lambda n, step: n + step["reports"]).alias("reports"),
    )
    began = F.unix_seconds("window.start")
    return ends.select(
        "window",
        "vn",
        *[F.col(f"a.first_{c}").alias(f"first_{c}") for c in ("lat", "lon")],
        *[F.col(f"z.last_{c}").alias(f"last_{c}") for c in ("lat", "lon")],
        (F.col("a.first") - began).alias("first_second"),
        (F.col("z.last") - began).alias("last_second"),
        "reports",
    )


def speeds(ends: DataFrame, config: C.ScoringConfig = C.DEFAULT) -> DataFrame:
    """Speed between the first and last report; null when no time passed."""

    def second(end: str) -> Column:
        timed = f"{end}_second"
        return F.col(timed) if timed in ends.columns else packed.high_of(F.col(f"{end}_order"))

    elapsed = second("last") - second("first")
    distance = haversine_km(
        F.col("first_lat"), F.col("first_lon"), F.col("last_lat"), F.col("last_lon")
    )

    def instant(end: str) -> Column:
        return F.timestamp_seconds(F.unix_seconds(F.col("window.start")) + second(end))

    speed = F.col("speed_kmh")
    return (
        ends.withColumn("first_ts", instant("first"))
        .withColumn("last_ts", instant("last"))
        .withColumn("distance_km", distance)
        .withColumn(
            "speed_kmh", F.when(elapsed > 0, F.col("distance_km") / (elapsed / F.lit(3600.0)))
        )
        .withColumn(
            "congested",
            F.coalesce(
                (speed > F.lit(config.congested_above_kmh))
                & (speed < F.lit(config.congested_below_kmh)),
                F.lit(False),
            ),
        )
        .drop("first_order", "last_order", "first_second", "last_second")
    )


def traffic_scores(moving: DataFrame) -> DataFrame:
    """Share of congested vehicles among all vehicles seen, per window."""
    counted = moving.groupBy("window").agg(
        F.count("*").alias("vehicles"), F.count_if(F.col("congested")).alias("congested")
    )
    share = F.col("congested") / F.col("vehicles")
    return counted.withColumn("traffic_score", F.least(share.cast("double"), F.lit(1.0)))


def slowest(moving: DataFrame) -> DataFrame:
    """Congested vehicles, slowest first."""
    return moving.filter("congested").orderBy("window", "speed_kmh", "first_ts", "vn")


def targets(moving: DataFrame, config: C.ScoringConfig = C.DEFAULT) -> DataFrame:
    """Ordered ids of the slowest few congested vehicles, one row per window.

    Ranking is limited on both sides of the shuffle, so a window sends at most
    that many rows per task and collects at most that many rows. Windows without
    congestion have an empty list.
    """
    order = Window.partitionBy("window").orderBy(
        F.desc("congested"), "speed_kmh", "first_ts", "vn"
    )
    ranked = (
        moving.select("window", "vn", "speed_kmh", "first_ts", "congested")
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= config.targets_per_decision)
    )
    few = F.array_sort(F.collect_list(F.when(F.col("congested"), F.struct("rank", "vn"))))
    return ranked.groupBy("window").agg(F.transform(few, lambda t: t["vn"]).alias("targets"))


def scores_with_targets(moving: DataFrame, config: C.ScoringConfig = C.DEFAULT) -> DataFrame:
    """Traffic score and targets of every window.

    Only congested vehicles are ranked, so no others are sorted; a window without any gets its
    empty list from the join. The window is rebuilt to be never null: no filter gets derived for
    one side only, the plans below stay equal, and the reports are read and shuffled once for both.
    """
    bounds = F.struct(F.col("window.start").alias("start"), F.col("window.end").alias("end"))
    moving = moving.withColumn("window", bounds)
    scored = traffic_scores(moving).join(targets(moving.filter("congested"), config), "window", "left")
    return scored.withColumn("targets", F.coalesce("targets", F.array().cast("array<string>")))


def tumbling_traffic(
    reports: DataFrame, length: str, config: C.ScoringConfig = C.DEFAULT
) -> DataFrame:
    return traffic_scores(speeds(sightings(reports, length), config))


def sliding_traffic(reports: DataFrame, config: C.ScoringConfig = C.DEFAULT) -> DataFrame:
    """Traffic score of the look-back window at every step."""
    return traffic_scores(speeds(sliding_sightings(reports, config.window, config.slide), config))
