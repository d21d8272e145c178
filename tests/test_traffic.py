import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from citysignal import config as C
from citysignal.operators import combine, search, traffic, weather
from citysignal.plans.decisions import decision_plan
from test_functions import python_km

SCHEMA = "vn STRING, ts TIMESTAMP, lat DOUBLE, lon DOUBLE, seq BIGINT"
T0 = datetime(2026, 1, 1, 8, 0, 0)
# One degree of latitude in kilometres.
DEGREE = python_km(0, 0, 1, 0)


def reports(spark, *rows):
    """Rows ``(vehicle, seconds after T0, lat, lon)`` numbered in writing order."""
    data = [(v, T0 + timedelta(seconds=s), lat, lon, i) for i, (v, s, lat, lon) in enumerate(rows)]
    return spark.createDataFrame(data, SCHEMA)


def moving(df, length="1 hour"):
    return traffic.speeds(traffic.sightings(df, length))


def north(kmh, seconds):
    return kmh * seconds / 3600 / DEGREE


@pytest.mark.parametrize(
    "kmh, congested",
    [(0.05, False), (0.0999, False), (0.1001, True), (10.0, True), (14.999, True), (15.001, False)],
)
def test_congestion_band(spark, kmh, congested):
    df = reports(spark, ("a", 0, 0.0, 0.0), ("a", 600, north(kmh, 600), 0.0))
    row = moving(df).first()
    assert row["speed_kmh"] == pytest.approx(kmh) and row["congested"] is congested


def test_band_edges_are_exclusive(spark):
    config = C.ScoringConfig(congested_above_kmh=0.0, congested_below_kmh=15.0)
    still = reports(spark, ("a", 0, 1.0, 1.0), ("a", 60, 1.0, 1.0))
    row = traffic.speeds(traffic.sightings(still, "1 hour"), config).first()
    assert (row["speed_kmh"], row["congested"]) == (0.0, False)
    speed = moving(reports(spark, ("a", 0, 0.0, 0.0), ("a", 600, 0.02, 0.0))).first()["speed_kmh"]
    edge = C.ScoringConfig(congested_below_kmh=speed)
    df = reports(spark, ("a", 0, 0.0, 0.0), ("a", 600, 0.02, 0.0))
    assert not traffic.speeds(traffic.sightings(df, "1 hour"), edge).first()["congested"]


def test_single_and_simultaneous_sightings_count_as_seen(spark):
    df = reports(
        spark,
        ("once", 5, 1.0, 1.0),
        ("same", 5, 1.0, 1.0),
        ("same", 5, 2.0, 2.0),
        ("slow", 0, 0.0, 0.0),
        ("slow", 600, north(5, 600), 0.0),
        ("lost", 0, None, None),
    )
    row = traffic.traffic_scores(moving(df)).first()
    assert (row["vehicles"], row["congested"], row["traffic_score"]) == (4, 1, 0.25)


def test_later_write_of_the_same_second_wins_on_both_ends(spark):
    df = reports(
        spark,
        ("a", 0, 9.0, 9.0),
        ("a", 0, 0.0, 0.5),
        ("a", 600, 8.0, 8.0),
        ("a", 600, 0.01, 0.6),
    )
    row = moving(df).first()
    assert (row["first_lat"], row["first_lon"], row["last_lat"], row["last_lon"]) == (0.0, 0.5, 0.01, 0.6)


def test_unplaced_report_is_skipped_not_its_vehicle(spark):
    df = reports(spark, ("a", 0, None, 1.0), ("a", 60, 0.0, 0.0), ("a", 660, north(7, 600), 0.0))
    assert moving(df).first()["speed_kmh"] == pytest.approx(7)


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_long_windows_and_any_sequence(spark, ansi):
    """A week is one window; sequences span BIGINT, and one is missing."""
    top, week = (1 << 63) - 1, datetime(2026, 1, 1)
    data = [
        ("a", week, 1.0, 1.0, None),
        ("a", week, 2.0, 2.0, -top - 1 + 5),
        ("a", week + timedelta(days=6), 3.0, 3.0, top - 1),
        ("a", week + timedelta(days=6), 4.0, 4.0, top),
    ]
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        ends = traffic.sightings(spark.createDataFrame(data, SCHEMA), "7 days")
        row = traffic.speeds(ends).first()
        assert "SortAggregate" not in ends._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    assert (row["first_lat"], row["first_lon"], row["last_lat"], row["last_lon"]) == (2, 2, 4, 4)
    assert (row["first_ts"], row["last_ts"]) == (data[0][1], data[2][1])


def test_windows_are_half_open(spark):
    df = reports(spark, ("a", 0, 0.0, 0.0), ("a", 3599, 0.0, 0.0), ("a", 3600, 0.0, 0.0))
    counts = [r["reports"] for r in traffic.sightings(df, "1 hour").orderBy("window").collect()]
    assert counts == [2, 1]


def test_targets_are_the_five_slowest_in_order(spark):
    rows = []
    for i, speed in enumerate([9, 3, 7, 3, 5, 11, 13, 80]):
        rows += [(f"v{i}", 10 - i, 0.0, 0.0), (f"v{i}", 610 - i, north(speed, 600), 0.0)]
    row = traffic.targets(moving(reports(spark, *rows))).first()
    # v3 was first seen before v1.
    assert row["targets"][:2] in (["v3", "v1"], ["v1", "v3"]) and row["targets"][2:] == ["v4", "v2", "v0"]
    slow = traffic.slowest(moving(reports(spark, *rows))).collect()
    assert [r["vn"] for r in slow][2:] == ["v4", "v2", "v0", "v5", "v6"]


def brute_force(data, length, step):
    """Score per window end over every step, straight from the definition."""
    stored = {}
    for vn, ts, lat, lon, seq in data:
        stored[(vn, ts.replace(microsecond=0))] = (seq, lat, lon)
    first = min(t for _, t in stored).replace(second=0) - length
    result = {}
    start = first
    while start <= max(t for _, t in stored):
        seen = defaultdict(list)
        for (vn, t), (_, lat, lon) in stored.items():
            if start <= t < start + length:
                seen[vn].append((t, lat, lon))
        if seen:
            stuck = 0
            for track in seen.values():
                track.sort()
                (t1, a1, o1), (t2, a2, o2) = track[0], track[-1]
                hours = (t2 - t1).total_seconds() / 3600
                if hours > 0 and 0.1 < python_km(a1, o1, a2, o2) / hours < 15:
                    stuck += 1
            result[start] = (len(seen), stuck)
        start += step
    return result


def random_reports(seed, n=300):
    rng = random.Random(seed)
    data = []
    for seq in range(n):
        # One vehicle sends a third of everything.
        vn = "hot" if rng.random() < 0.34 else f"v{rng.randrange(12)}"
        ts = T0 + timedelta(seconds=rng.randrange(2400), microseconds=rng.randrange(10**6))
        data.append((vn, ts, 52 + rng.random() / 50, 21 + rng.random() / 50, seq))
    return data


@pytest.mark.parametrize("seed", [1, 2])
def test_sliding_matches_brute_force(spark, seed):
    data = random_reports(seed)
    got = traffic.sliding_traffic(spark.createDataFrame(data, SCHEMA))
    found = {
        r["window"]["start"]: (r["vehicles"], r["congested"]) for r in got.collect()
    }
    assert found == brute_force(data, timedelta(minutes=10), timedelta(minutes=1))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_first_last_is_hash_aggregated_with_a_partial_step(spark):
    df = traffic.sightings(spark.createDataFrame(random_reports(3), SCHEMA), "1 hour")
    text = plan(df)
    assert "partial_min_by" in text and "SortAggregate" not in text


def test_ranking_is_limited_before_the_shuffle(spark):
    df = traffic.targets(moving(spark.createDataFrame(random_reports(3), SCHEMA)))
    text = plan(df)
    assert "row_number(), 5, Partial" in text and "row_number(), 5, Final" in text


def score_frame(spark, name, *rows):
    data = [(T0 + timedelta(hours=h), value) for h, value in rows]
    return spark.createDataFrame(data, f"instant TIMESTAMP, {name}_score DOUBLE")


def test_missing_sources_count_as_zero(spark):
    got = combine.combine_signals(
        score_frame(spark, "traffic", (0, 0.9), (3, None)),
        score_frame(spark, "weather", (1, 0.8)),
        score_frame(spark, "sentiment", (0, 0.4), (2, 0.7)),
    ).orderBy("instant")
    parts = ("traffic", "weather", "sentiment")
    values = [tuple(r[f"{p}_score"] for p in parts) for r in got.collect()]
    # The fourth hour has no data at all and yields no decision.
    assert values == [(0.9, 0.0, 0.4), (0.0, 0.8, 0.0), (0.0, 0.0, 0.7)]
    flags = [tuple(r[f"{p}_found"] for p in parts) for r in got.collect()]
    assert flags == [(True, False, True), (False, True, False), (False, False, True)]


def test_decisions(spark):
    signals = combine.fill_signals(
        spark.createDataFrame(
            [
                (T0, 1.0, 0.25, 0.0, ["1"]),
                (T0 + timedelta(hours=1), 1.0, 1.0, 1.0, ["2", "3"]),
                (T0 + timedelta(hours=2), 1.0, 1.0, 1.0, []),
                (T0 + timedelta(hours=3), None, 1.0, 1.0, None),
            ],
            "instant TIMESTAMP, traffic_score DOUBLE, weather_score DOUBLE,"
            " sentiment_score DOUBLE, targets ARRAY<STRING>",
        )
    )
    made = combine.decide(signals).orderBy("decision_id").collect()
    assert [r["decision_id"] for r in made] == [f"20260101_{h}0000" for h in ("08", "09", "10", "11")]
    # 0.4 + 0.1 is exactly the cut.
    assert [r["decision_result"] for r in made] == ["NO_AD"] + ["SHOW_AD"] * 3
    assert [r["campaign_type"] for r in made] == ["", "ESCAPISM_NOW", "", ""]
    assert [r["targets"] for r in made] == [[], ["2", "3"], [], []]
    assert (made[0]["display_time"] - made[0]["decision_time"]) == timedelta(minutes=5)


def test_weather_is_taken_from_the_very_hour(spark):
    hourly = spark.createDataFrame(
        [("20260101_08", 60.0)],
        "row_key STRING, wind_speed DOUBLE",
    )
    for name in ("temp_2m", "apparent_temp", "rain", "snowfall", "snow_depth"):
        hourly = hourly.withColumn(name, F.lit(None).cast("double"))
    hourly = hourly.withColumn("weather_code", F.lit(None).cast("int"))
    at = spark.createDataFrame([(T0 + timedelta(minutes=59),), (T0 + timedelta(hours=1),)], "instant TIMESTAMP")
    got = weather.weather_at(at, hourly).orderBy("instant").collect()
    assert [(r["weather_score"], r["weather_found"]) for r in got] == [
        (pytest.approx(0.24), True),
        (None, False),
    ]


def test_sliding_decision_plan_agrees_with_its_parts(spark):
    data = random_reports(5)
    df = spark.createDataFrame(data, SCHEMA)
    moods = spark.createDataFrame(
        [(ts, seq % 10) for _, ts, _, _, seq in data], "ts TIMESTAMP, sentiment_score INT"
    )
    hourly = spark.createDataFrame([], "row_key STRING")
    for name in ("temp_2m", "apparent_temp", "rain", "snowfall", "snow_depth", "wind_speed"):
        hourly = hourly.withColumn(name, F.lit(None).cast("double"))
    hourly = hourly.withColumn("weather_code", F.lit(None).cast("int"))
    made = {r["decision_time"]: r for r in decision_plan(df, moods, hourly).collect()}
    want = brute_force(data, timedelta(minutes=10), timedelta(minutes=1))
    assert len(made) == len(want)
    for start, (vehicles, stuck) in want.items():
        row = made[start + timedelta(minutes=10)]
        assert row["traffic_score"] == pytest.approx(stuck / vehicles)
        assert len(row["targets"]) == (min(stuck, 5) if row["decision_result"] == "SHOW_AD" else 0)


def test_any_one_source_is_enough_for_a_decision(spark):
    no_reports = spark.createDataFrame([], SCHEMA)
    no_moods = spark.createDataFrame([], "ts TIMESTAMP, sentiment_score INT")
    hourly = spark.createDataFrame(
        [("20260101_08", 60.0), ("20260102_00", 10.0), ("odd", 1.0)],
        "row_key STRING, wind_speed DOUBLE",
    )
    for name in ("temp_2m", "apparent_temp", "rain", "snowfall", "snow_depth"):
        hourly = hourly.withColumn(name, F.lit(None).cast("double"))
    hourly = hourly.withColumn("weather_code", F.lit(None).cast("int"))
    minutes = decision_plan(no_reports, no_moods, hourly).orderBy("decision_id").collect()
    assert [r["decision_id"] for r in minutes] == [
        f"{hour}{m:02d}00" for hour in ("20260101_08", "20260102_00") for m in range(60)
    ]
    assert [r["weather_score"] for r in minutes[:60]] == pytest.approx([0.24] * 60)
    assert {(r["traffic_score"], r["sentiment_score"]) for r in minutes} == {(0.0, 0.0)}
    days = decision_plan(no_reports, no_moods, hourly, length="1 day").collect()
    assert [r["decision_id"] for r in days] == ["20260102_000000"]
    local = decision_plan(no_reports, no_moods, hourly, length="1 hour", tz="Europe/Warsaw")
    assert sorted(r["decision_id"] for r in local.collect()) == ["20260101_080000", "20260102_000000"]
    quiet = hourly.filter("false")
    assert decision_plan(no_reports, no_moods, quiet).count() == 0
    mood = spark.createDataFrame([(T0, 1)], "ts TIMESTAMP, sentiment_score INT")
    assert decision_plan(no_reports, mood, quiet).count() == 10


def test_search(spark):
    posts = spark.createDataFrame(
        [
            ("1", T0, 52.23, 21.01, "smog", 1, 1, 1),
            ("2", T0, 52.23, 21.01, "slonce", 9, 9, 9),
            ("3", T0 - timedelta(hours=30), 52.23, 21.01, "korek", 5, 5, 5),
            ("4", T0, 50.06, 19.94, "zimno", 7, 7, 7),
            ("5", T0 - timedelta(hours=2), 52.30, 21.00, "Ale korek", 3, 3, 3),
        ],
        "tweet_id STRING, ts TIMESTAMP, lat DOUBLE, lon DOUBLE, text STRING,"
        " like_count BIGINT, retweet_count BIGINT, reply_count BIGINT",
    )

    def ids(**options):
        return [r["tweet_id"] for r in search.search(posts, **options).collect()]

    words = {"keywords": C.SEARCH_KEYWORDS}
    place = {"centre": C.SEARCH_CENTRE}
    day = {"as_of": "2026-01-01 08:00:00"}
    assert ids() == ["1", "2", "4", "5", "3"]
    assert ids(**words) == ["1", "4", "5", "3"]
    assert ids(**place) == ["1", "2", "5", "3"]
    assert ids(**words, **place) == ["1", "5", "3"]
    assert ids(**words, **place, **day) == ["1", "5"]
    assert ids(**words, **place, order="top") == ["3", "5", "1"]
    assert ids(**words, **place, **day, order="top") == ["5", "1"]
    assert ids(limit=1) == ["1"]


def test_scores_and_targets_share_one_shuffle_of_the_reports(spark):
    df = spark.createDataFrame(random_reports(6), SCHEMA)
    moods = df.select("ts", F.col("seq").cast("int").alias("sentiment_score"))
    columns = "temp_2m apparent_temp rain snowfall snow_depth wind_speed".split()
    hourly = spark.createDataFrame(
        [], "row_key STRING, weather_code INT, " + ", ".join(f"{c} DOUBLE" for c in columns)
    )
    for length in ("1 hour", None):
        made = decision_plan(df, moods, hourly, length=length)
        made.collect()
        reused = [line for line in plan(made).splitlines() if "ReusedExchange" in line]
        assert any(" vn#" in line for line in reused)


def test_copies_into_sliding_windows_are_not_shuffled(spark):
    df = traffic.sliding_sightings(spark.createDataFrame(random_reports(3), SCHEMA), "10 minutes", "1 minute")
    text = plan(df)
    shuffles = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    # By step and vehicle for the partial results, then by vehicle; none by window.
    assert len(shuffles) == 2 and "hashpartitioning(vn" in shuffles[0]


def test_copies_into_sliding_windows_are_not_kept(spark):
    reports = spark.createDataFrame(random_reports(3), SCHEMA)
    text = plan(traffic.sliding_sightings(reports, "10 minutes", "1 minute"))
    tree = text.split("Initial Plan")[-1]
    # Steps are aggregated, in two parts; windows come from them one by one.
    assert tree.count("HashAggregate(") == 2
    above = tree[: tree.index("Generate explode")]
    assert "Sort [" not in above and "Aggregate" not in above


def test_only_congested_vehicles_are_ranked_for_the_plan(spark):
    df = traffic.sliding_sightings(spark.createDataFrame(random_reports(3), SCHEMA), "10 minutes", "1 minute")
    text = plan(traffic.scores_with_targets(traffic.speeds(df)))
    below = text[text.index("row_number(), 5, Partial") :]
    assert "Filter" in below[: below.index("Generate explode")]


def test_sliding_ends_over_gaps_and_reports_without_a_position(spark):
    data = [
        ("a", T0 + timedelta(seconds=s), lat, lat and 21.0, i)
        for i, (s, lat) in enumerate([(5, 52.0), (125, None), (126, 52.1), (400, None), (1230, 52.2), (6000, None)])
    ] + [("b", T0 + timedelta(seconds=3), None, None, 9)]
    got = traffic.speeds(
        traffic.sliding_sightings(spark.createDataFrame(data, SCHEMA), "10 minutes", "1 minute")
    ).collect()
    want = {}
    for start in range(-600, 6060, 60):
        for vn in "ab":
            inside = [r for r in data if r[0] == vn and start <= (r[1] - T0).total_seconds() < start + 600]
            if inside:
                placed = [r for r in inside if r[2] is not None] or [(vn, None, None, None, None)]
                want[T0 + timedelta(seconds=start), vn] = (
                    len(inside), placed[0][1], placed[0][2], placed[-1][1], placed[-1][2]
                )
    found = {
        (r["window"]["start"], r["vn"]): tuple(
            r[c] for c in ("reports", "first_ts", "first_lat", "last_ts", "last_lat")
        )
        for r in got
    }
    assert len(got) == len(found) and found == want


def test_a_window_that_is_no_multiple_of_the_slide_is_refused(spark):
    reports = spark.createDataFrame([], "vn string, ts timestamp, seq long, lat double, lon double")
    with pytest.raises(ValueError, match="multiple"):
        traffic.sliding_sightings(reports, "10 minutes", "3 minutes")
