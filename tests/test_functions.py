import math

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from citysignal import config as C
from citysignal.functions import decision, geo, keys, sentiment, text
from citysignal.functions.weather import WeatherFactors
from citysignal.operators import weather


def forecast(spark, **values):
    names = ("temp_2m", "apparent_temp", "rain", "snowfall", "snow_depth", "wind_speed")
    row = tuple(values.get(name) for name in names) + (values.get("weather_code"),)
    schema = ", ".join(f"{n} DOUBLE" for n in names) + ", weather_code INT"
    return spark.createDataFrame([row], schema)


def points(spark, name, **values):
    return weather.factors(forecast(spark, **values)).first()[name]


@pytest.mark.parametrize(
    "apparent, expected",
    [
        (-0.1, 0.4),
        (0.0, 0.3),
        (9.9, 0.3),
        (10.0, 0.15),
        (14.9, 0.15),
        (15.0, 0.0),
        (25.0, 0.0),
        (25.1, 0.15),
        (30.0, 0.15),
        (30.1, 0.3),
    ],
)
def test_temperature_bands(spark, apparent, expected):
    assert points(spark, "temperature_points", temp_2m=20.0, apparent_temp=apparent) == expected


def test_temperature_falls_back_to_measured(spark):
    assert points(spark, "temperature_points", temp_2m=-5.0) == 0.4
    assert points(spark, "temperature_points") == 0.0
    # A felt temperature of exactly zero is a reading, not a gap.
    assert points(spark, "temperature_points", temp_2m=20.0, apparent_temp=0.0) == 0.3


@pytest.mark.parametrize(
    "rain, expected",
    [(0.1, 0.0), (0.11, 0.05), (1.0, 0.05), (1.1, 0.1), (5.0, 0.1), (5.1, 0.2), (10.0, 0.2), (10.1, 0.3)],
)
def test_precipitation_bands(spark, rain, expected):
    assert points(spark, "precipitation_points", rain=rain) == expected


def test_snow_counts_as_precipitation_and_surcharge(spark):
    assert points(spark, "precipitation_points", rain=1.0, snowfall=0.0625) == 0.2
    assert points(spark, "snow_points", snowfall=0.005) == 0.0
    assert points(spark, "snow_points", snowfall=0.0051) == 0.1


@pytest.mark.parametrize(
    "cm, expected",
    [(1, 0.0), (1.5, 0.05), (5, 0.05), (5.5, 0.1), (10, 0.1), (10.5, 0.15), (20, 0.15), (20.5, 0.2), (30, 0.2), (30.5, 0.25)],
)
def test_depth_bands(spark, cm, expected):
    assert points(spark, "depth_points", snow_depth=cm / 100) == expected


@pytest.mark.parametrize(
    "wind, expected",
    [(10.0, 0.0), (10.1, 0.05), (20.0, 0.05), (20.1, 0.1), (30.0, 0.1), (30.1, 0.15), (50.0, 0.15), (50.1, 0.2)],
)
def test_wind_bands(spark, wind, expected):
    assert points(spark, "wind_points", wind_speed=wind) == expected


def test_weather_codes(spark):
    assert points(spark, "code_points", weather_code=95) == 0.1
    assert points(spark, "code_points", weather_code=61) == 0.05
    assert points(spark, "code_points", weather_code=3) == 0.0
    off = C.ScoringConfig(use_weather_code=False)
    scored = weather.factors(forecast(spark, weather_code=95), off)
    assert scored.first()["code_points"] == 0.0


def score(spark, hour, config=C.DEFAULT, **values):
    return weather.scores(forecast(spark, **values), F.lit(hour), config).first()["weather_score"]


def test_rush_hour_and_cap(spark):
    assert score(spark, 8, rain=2.0) == pytest.approx(0.12)
    assert score(spark, 10, rain=2.0) == pytest.approx(0.1)
    assert score(spark, 8, temp_2m=20.0) == 0.0
    worst = dict(temp_2m=-9.0, rain=20.0, snowfall=0.5, snow_depth=0.5, wind_speed=80.0)
    assert score(spark, 12, **worst) == 1.0
    assert score(spark, 8, **worst) == 1.0


def test_missing_measures_only_drop_their_own_factor(spark):
    assert score(spark, 12, wind_speed=60.0) == pytest.approx(0.2)
    assert score(spark, 12) == 0.0


def test_explain(spark):
    df = forecast(spark, apparent_temp=-1.0, rain=0.2, snowfall=0.01, weather_code=75)
    note = weather.explained(df, F.lit(17)).first()["factors_used"]
    assert note == "temp=-1.0°C, rain=0.2mm, snow=1.0mm, severe_weather=75, rush_hour_x1.2"
    assert weather.explained(forecast(spark), F.lit(17)).first()["factors_used"] == ""


def test_factor_names_match_columns(spark):
    assert list(WeatherFactors.of_forecast().points()) == [
        f"{n}_points" for n in ("temperature", "precipitation", "snow", "depth", "wind", "code")
    ]


@pytest.mark.parametrize(
    "compound, bucket",
    [(-1.0, 0), (-0.112, 3), (-0.111, 4), (0.0, 4), (0.12, 5), (1.0, 9), (-1.5, 0), (1.5, 9)],
)
def test_sentiment_bucket(spark, compound, bucket):
    got = spark.range(1).select(sentiment.bucket(F.lit(compound)).alias("b")).first()["b"]
    assert got == bucket


def test_negative_flag(spark):
    df = spark.createDataFrame([(3,), (4,), (None,)], "s INT")
    assert [r[0] for r in df.select(sentiment.is_negative(F.col("s"))).collect()] == [
        True,
        False,
        False,
    ]


def test_cut_is_strict_and_campaign_needs_targets(spark):
    none = F.array().cast("array<string>")
    row = spark.range(1).select(
        decision.result(F.lit(0.5)).alias("at"),
        decision.result(F.lit(0.5000001)).alias("above"),
        decision.campaign(F.lit("SHOW_AD"), none).alias("idle"),
        decision.campaign(F.lit("SHOW_AD"), F.array(F.lit("7"))).alias("run"),
        decision.campaign(F.lit("NO_AD"), F.array(F.lit("7"))).alias("off"),
        decision.global_score(F.lit(1.0), F.lit(0.5), F.lit(0.25)).alias("score"),
        decision.global_score(F.lit(1.0), F.lit(0.5), F.lit(0.25), C.DOCUMENTED).alias("other"),
    )
    assert row.first() == ("NO_AD", "SHOW_AD", "", "ESCAPISM_NOW", "", pytest.approx(0.65), pytest.approx(0.7))


def test_keys(spark):
    ts = F.lit("2026-01-08 14:30:05.9").cast("timestamp")
    null = F.lit(None).cast("string")
    row = spark.range(1).select(
        keys.vehicle_key(ts, F.lit("12")),
        keys.vehicle_key(ts, null),
        keys.tweet_key(ts, F.lit("12")),
        keys.tweet_key(ts, null),
        keys.forecast_key(F.lit("2026-01-02T00:00")),
        keys.forecast_key(F.lit("soon")),
        keys.hour_key(ts, "Europe/Warsaw"),
        keys.key_timestamp(F.lit("20260108_143005_12")).cast("string"),
        keys.key_timestamp(F.lit("sensor_7")),
        keys.key_timestamp(F.lit("sensor")),
    )
    assert tuple(row.first()) == (
        "20260108_143005_12",
        "20260108_143005",
        "20260108_143005_12",
        None,
        "20260102_00",
        None,
        "20260108_15",
        "2026-01-08 14:30:05",
        None,
        None,
    )


def test_recent_bounds(spark):
    row = spark.range(1).select(*keys.recent_bounds("2026-01-08 00:05:00", "10 minutes")).first()
    assert tuple(row) == ("20260107_235500", "20260108_000500")


def test_rendering(spark):
    row = spark.range(1).select(
        text.quoted_list(F.array(F.lit("a"), F.lit("b"))),
        text.quoted_list(F.array().cast("array<string>")),
        text.quoted_list(F.lit(None).cast("array<string>")),
    )
    assert tuple(row.first()) == ("['a', 'b']", "[]", "[]")


def test_keywords_are_whole_words_and_escaped(spark):
    df = spark.createDataFrame(
        [("Ale KOREK!",), ("korekta",), ("a+b is",), ("aab is",), ("zły smog jest",), (None,)],
        "t STRING",
    )
    hits = df.select(text.mentions_any(F.col("t"), ["korek", "a+b", "smog jest"])).collect()
    assert [r[0] for r in hits] == [True, False, True, False, True, None]


def python_km(lat1, lon1, lat2, lon2):
    p1, p2 = math.radians(lat1), math.radians(lat2)
    a = (
        math.sin((p2 - p1) / 2) ** 2
        + math.cos(p1) * math.cos(p2) * math.sin(math.radians(lon2 - lon1) / 2) ** 2
    )
    return 2 * 6371 * math.asin(min(1, math.sqrt(a)))


def test_haversine(spark):
    points = [(52.2297, 21.0122, 50.0647, 19.9450), (0, 0, 0, 90), (10, 10, 10, 10)]
    df = spark.createDataFrame([tuple(map(float, p)) for p in points], "a DOUBLE, b DOUBLE, c DOUBLE, d DOUBLE")
    got = [r[0] for r in df.select(geo.haversine_km(*map(F.col, "abcd"))).collect()]
    assert got == pytest.approx([python_km(*p) for p in points], abs=1e-6)


@given(
    st.floats(-89, 89), st.floats(-179, 179), st.floats(0.1, 3000), st.floats(0, 360), st.floats(0, 1)
)
def test_bounding_box_holds_the_circle(lat, lon, radius, bearing, share):
    """Walk from the centre by part of the radius: the end point is in the box."""
    d, b, p = radius * share / 6371, math.radians(bearing), math.radians(lat)
    end = math.asin(math.sin(p) * math.cos(d) + math.cos(p) * math.sin(d) * math.cos(b))
    turn = math.atan2(math.sin(b) * math.sin(d) * math.cos(p), math.cos(d) - math.sin(p) * math.sin(end))
    there = (lon + math.degrees(turn) + 180) % 360 - 180
    south, north, west, east = geo.bounding_box(lat, lon, radius)
    assert south - 1e-6 <= math.degrees(end) <= north + 1e-6
    assert west - 1e-6 <= there <= east + 1e-6
