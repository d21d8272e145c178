import json

import pytest
from pyspark.sql import functions as F

from citysignal import schemas
from citysignal.operators import parse
from citysignal.sources import samples, scans
from citysignal.sources.envelopes import spread

AT = "2026-01-02 10:00:00"


def messages(spark, *bodies):
    texts = [b if isinstance(b, str) else json.dumps(b) for b in bodies]
    df = spark.createDataFrame([(t,) for t in texts], "json STRING")
    return df.withColumn("kafka_ts", F.lit("2026-01-01 00:20:30").cast("timestamp"))


BUS = {
    "Lines": "26",
    "Lon": 21.055733,
    "VehicleNumber": "1294",
    "Time": "2026-01-01 00:20:28",
    "Lat": 52.25588,
    "Brigade": "015",
}


def test_vehicles(spark):
    df = messages(spark, {"result": [BUS]})
    row = parse.parse_vehicles(df, "bus", ingested_at=AT).first()
    assert row["row_key"] == "20260101_002028_1294"
    assert (row["lines"], row["brigade"], row["lat"], row["lon"]) == ("26", "015", 52.25588, 21.055733)
    assert row["vehicle_type"] == "bus"
    arrival = parse.parse_vehicles(df, "bus", event_time="arrival", ingested_at=AT).first()
    assert arrival["row_key"] == "20260101_002030_1294"
    processing = parse.parse_vehicles(df, "bus", event_time="processing", ingested_at=AT, tz="Europe/Warsaw")
    assert processing.first()["row_key"] == "20260102_110000_1294"


def test_unreadable_messages_yield_nothing_and_are_set_aside(spark, rows):
    df = messages(
        spark, "{not json", {"result": "down"}, {"result": []}, {}, {"result": None}, {"result": [BUS]}
    )
    assert parse.parse_vehicles(df, "bus").count() == 1
    good, bad = parse.quarantine_messages(df)
    assert good.count() == 2
    assert rows(bad, "reason") == [("unreadable",)] * 4


def test_wrong_type_nulls_only_that_field(spark):
    row = parse.parse_vehicles(messages(spark, {"result": [{**BUS, "Lat": "52.1"}]}), "bus").first()
    assert row["lat"] is None and row["lon"] == 21.055733


def test_row_quarantine_reports_first_reason(spark, rows):
    cases = [
        {**BUS},
        {**BUS, "VehicleNumber": None},
        {**BUS, "VehicleNumber": ""},
        {**BUS, "Time": "later"},
        {**BUS, "Lat": None},
        {**BUS, "Lat": None, "Time": None},
    ]
    good, bad = parse.quarantine_vehicles(parse.parse_vehicles(messages(spark, {"result": cases}), "bus"))
    assert good.count() == 1
    assert rows(bad, "reason") == [("bad_time",)] * 2 + [("no_position",)] + [("no_vehicle",)] * 2


def hourly(**arrays):
    return {"hourly": arrays}


def test_hourly_arrays_become_rows(spark):
    body = hourly(
        time=["2026-01-02T00:00", "2026-01-02T01:00", "pending"],
        temperature_2m=[15.5, 14.0, 13.0],
        weather_code=[61, None, 3],
        rain=[2.5],
    )
    got = parse.parse_hourly(messages(spark, body), schemas.WEATHER, ingested_at=AT)
    found = got.select("row_key", "temp_2m", "weather_code", "rain", "wind_speed", "forecast_time").collect()
    assert [tuple(r) for r in found] == [
        ("20260102_00", 15.5, 61, 2.5, None, "2026-01-02T00:00"),
        ("20260102_01", 14.0, None, None, None, "2026-01-02T01:00"),
        (None, 13.0, 3, None, None, "pending"),
    ]
    good, bad = parse.quarantine_keyed(got)
    assert (good.count(), bad.first()["reason"]) == (2, "no_key")


def test_strict_zip_drops_messages_with_an_absent_array(spark):
    body = hourly(time=["2026-01-02T00:00"], temperature_2m=[15.5])
    assert parse.zip_hourly(messages(spark, body), schemas.WEATHER, strict=True).count() == 0
    assert parse.zip_hourly(messages(spark, body), schemas.WEATHER).count() == 1


def test_longer_array_adds_an_hour_without_key(spark):
    body = hourly(time=["2026-01-02T00:00"], pm10=[1.0, 2.0])
    got = parse.parse_hourly(messages(spark, body), schemas.AIR_QUALITY)
    assert [tuple(r) for r in got.select("row_key", "pm10").collect()] == [
        ("20260102_00", 1.0),
        (None, 2.0),
    ]


def test_tweets(spark):
    tweet = {
        "id": "9",
        "text": "Stoję \n w korku",
        "createdAt": "2026-01-01",
        "author": {"userName": "jan", "name": "Jan", "id": "1"},
        "entities": {"hashtags": [{"text": "a", "indices": [0, 1]}, {"text": "b"}]},
        "lang": "pl",
        "likeCount": 1,
        "retweetCount": 2,
        "replyCount": 3,
        "viewCount": 5_000_000_000,
    }
    bare = {"id": "10", "text": None}
    df = messages(spark, {"tweets": [tweet, bare]}, {"tweets": None}, {"tweets": []})
    first, second = parse.parse_tweets(df, ingested_at=AT).orderBy("tweet_id").collect()[::-1]
    assert first["row_key"] == "20260101_002030_9"
    assert (first["author_name"], first["username"], first["hashtags"]) == ("Jan", "jan", "a,b")
    assert first["view_count"] == 5_000_000_000
    assert first["data_acquisition_date"] == "2026-01-01"
    assert first["ingestion_timestamp"] == AT
    assert (second["hashtags"], second["author_name"]) == ("", None)


def test_normalised_tweets_accept_both_field_sets(spark, rows):
    tags = {"hashtags": [{"text": "x"}, {"text": ""}, {}]}
    df = messages(
        spark,
        {
            "tweets": [
                {"id": "1", "createdAt": "c", "author": {"name": "", "userName": "u"}, "text": "t", "entities": tags},
                {"id": "", "id_str": "2", "created_at": "d", "user": {"screen_name": "s"}, "text": "", "full_text": "f"},
                {"id": "3"},
            ]
        },
    )
    got = parse.normalize_tweets(df, acquired_on=AT)
    assert rows(got) == [
        ("1", "c", "u", "t", "#x", "2026-01-02"),
        ("2", "d", "s", "f", "", "2026-01-02"),
        ("3", "", "Unknown", "", "", "2026-01-02"),
    ]


def test_union_keeps_both_kinds(spark, rows):
    one = messages(spark, {"result": [BUS]})
    both = parse.union_feeds(parse.parse_vehicles(one, "bus"), parse.parse_vehicles(one, "trolley"))
    assert rows(both, "vehicle_type") == [("bus",), ("trolley",)]


def test_defaults(spark, rows):
    schema = (
        "decision_id STRING, traffic_score STRING, weather_score STRING, sentiment_score STRING,"
        " global_score STRING, decision_result STRING, target_locations STRING,"
        " decision_time STRING, display_time STRING"
    )
    df = spark.createDataFrame([("20260101_000000", "0.5", "None", "", None) + (None,) * 4], schema)
    assert rows(scans.with_defaults(df)) == [
        ("20260101_000000", 0.5, 0.0, 0.0, 0.0, "NO_AD", "[]", "", "")
    ]


def test_samples_are_repeatable_and_uniform(spark):
    df = samples.sample_decisions(spark, 2000)
    assert df.exceptAll(samples.sample_decisions(spark, 2000)).count() == 0
    mean, low, high = df.agg(F.avg("traffic_score"), F.min("traffic_score"), F.max("traffic_score")).first()
    assert mean == pytest.approx(0.5, abs=0.03) and 0 <= low < 0.01 and 0.99 < high < 1
    assert df.select("decision_id").distinct().count() == 2000


def test_scan_bounds_are_half_open_and_prune(spark, tmp_path):
    ids = ["20260101_235959", "20260102_000000", "20260102_003000", "20260102_010000", "20260103_000000"]
    df = spark.createDataFrame([(i, i[:8], i[9:11]) for i in ids], "row_key STRING, dt STRING, hr STRING")
    path = str(tmp_path / "t")
    df.write.partitionBy("dt", "hr").parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    found = scans.scan_range(stored, "20260102_000000", "20260102_010000")
    assert sorted(r["row_key"] for r in found.collect()) == ids[1:3]
    # Whole folders outside the range are never opened.
    assert len(found.inputFiles()) == 5
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan and "PushedFilters: [IsNotNull(row_key)" in plan
    assert [r["row_key"] for r in scans.get_row(stored, ids[3]).collect()] == [ids[3]]
    assert [r["row_key"] for r in scans.scan_limit(stored, 2).collect()] == ids[:2]


def test_one_pass_judgement_agrees_with_the_two_step_split(spark, rows):
    cases = [{**BUS}, {**BUS, "VehicleNumber": None}, {**BUS, "Time": "later"}, {**BUS, "Lat": None}]
    df = messages(spark, "{not json", {"result": "down"}, {"result": []}, {"result": cases})
    judged = parse.judged_vehicles(df, "bus", ingested_at=AT)
    good, bad_messages = parse.quarantine_messages(df)
    accepted, bad_rows = parse.quarantine_vehicles(parse.parse_vehicles(good, "bus", ingested_at=AT))
    assert rows(judged.filter("reason IS NULL").select(accepted.columns)) == rows(accepted)
    assert rows(judged.filter("reason = 'unreadable'"), "json") == rows(bad_messages, "json")
    assert rows(judged.filter("reason <> 'unreadable'"), "reason") == rows(bad_rows, "reason")


def test_a_split_with_most_of_the_rows_is_dealt_out(spark):
    """Row groups are not cut, so splits by bytes may leave all rows to one task."""
    cores = spark.sparkContext.defaultParallelism
    one = spark.range(0, 1000, 1, cores).filter("id >= 0").repartition(cores, F.lit(1))
    assert spread(one).rdd.getNumPartitions() == cores
    dealt = spread(one).groupBy(F.spark_partition_id()).count().collect()
    assert max(row["count"] for row in dealt) < 300


def test_tasks_of_costly_rows_grow_in_number_not_in_size(spark):
    cores = spark.sparkContext.defaultParallelism
    even = spark.range(0, 100 * cores, 1, cores)
    assert spread(even).rdd.getNumPartitions() == cores
    assert spread(even, rows=20).rdd.getNumPartitions() == 5 * cores
