from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from citysignal.functions import keys
from citysignal.operators.state import latest_state
from citysignal.operators.store import KeyedTable, latest_per_key, retained
from citysignal.plans import archive
from citysignal.sinks import layers, publish

SCHEMA = "row_key STRING, value STRING, seq BIGINT"


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


@pytest.fixture
def table(spark, tmp_path):
    return KeyedTable(spark, str(tmp_path / "table"))


def test_last_write_wins_whole_rows(spark, rows):
    df = frame(spark, ("a", "x", 1), ("a", None, 3), ("a", "y", 2), ("b", "z", 1))
    assert rows(latest_per_key(df, "row_key", ["seq"])) == [("a", None, 3), ("b", "z", 1)]


def test_hot_key_is_reduced_before_the_shuffle(spark):
    df = spark.range(10_000).select(F.lit("k").alias("row_key"), F.col("id").alias("seq"))
    latest = latest_per_key(df, "row_key", ["seq"])
    assert latest.first()["seq"] == 9_999
    assert "partial_max_by" in latest._jdf.queryExecution().executedPlan().toString()


def test_upsert_replay_and_order_of_batches(spark, table, rows):
    table.upsert(frame(spark, ("20260101_00", "old", 9), ("20260102_00", "b", 1)), 0)
    table.upsert(frame(spark, ("20260101_00", "new", 1)), 1)
    want = [("20260101_00", "new", 1), ("20260102_00", "b", 1)]
    assert rows(table.latest()) == want
    # A batch that is repeated replaces itself, also when it shrank.
    table.upsert(frame(spark, ("20260101_00", "new", 1)), 1)
    table.upsert(frame(spark, ("20260102_00", "b", 1)), 0)
    assert rows(table.latest()) == want
    assert table.log().count() == 2


def test_get_and_scan(spark, table, rows):
    table.upsert(frame(spark, *((f"2026010{d}_00", f"v{d}", 1) for d in range(1, 6))), 0)
    table.upsert(frame(spark, ("20260103_00", "again", 1)), 1)
    assert rows(table.get("20260103_00")) == [("20260103_00", "again", 1)]
    assert rows(table.get("20260109_00")) == []
    assert [r[0] for r in rows(table.scan("20260102_00", "20260104_00"))] == ["20260102_00", "20260103_00"]


def test_compaction_into_a_new_table(spark, table, rows, tmp_path):
    table.upsert(frame(spark, ("20260101_00", "a", 1), ("20260102_00", "b", 1)), 0)
    table.upsert(frame(spark, ("20260102_00", "c", 1), ("20260103_00", "d", 1)), 1)
    want = [("20260101_00", "a", 1), ("20260102_00", "c", 1), ("20260103_00", "d", 1)]
    small = table.compact_into(str(tmp_path / "small"))
    assert rows(small.latest()) == rows(table.latest()) == want
    assert small.log().count() == 3
    # Later writes win, whatever their batch id and order column.
    small.upsert(frame(spark, ("20260101_00", "e", 0)), 0)
    assert rows(small.get("20260101_00")) == [("20260101_00", "e", 0)]
    with pytest.raises(Exception, match="already exists|ALREADY_EXISTS"):
        table.compact_into(str(tmp_path / "small"))


def test_writers_do_not_overwrite_each_other(spark, table, rows):
    table.upsert(frame(spark, ("20260101_00", "bus", 5)), 0, writer="buses")
    table.upsert(frame(spark, ("20260101_01", "tram", 5)), 0, writer="trams")
    assert [r[1] for r in rows(table.latest())] == ["bus", "tram"]
    # A writer that starts afresh counts from zero; its write is the last one.
    table.upsert(frame(spark, ("20260101_00", "again", 1)), 0, writer="buses2")
    assert [r[1] for r in rows(table.latest())] == ["again", "tram"]


def test_rows_without_key_are_refused(spark, table):
    with pytest.raises(Exception, match="a row has no row_key"):
        table.upsert(frame(spark, (None, "x", 1)), 0)
    assert table.log() is None


def test_null_order_is_lowest_for_plain_numbers_and_text(spark, rows):
    plain = spark.createDataFrame([("k", 7, None)], "k STRING, v INT, seq BIGINT")
    text = spark.createDataFrame([("k", "7", None)], "k STRING, v STRING, seq BIGINT")
    assert rows(latest_per_key(plain, "k", ["seq"])) == [("k", 7, None)]
    assert rows(latest_per_key(text, "k", ["seq"])) == [("k", "7", None)]


def test_tables_of_numbers_are_reduced_by_hashing(spark, tmp_path, rows):
    table = KeyedTable(spark, str(tmp_path / "plain"))
    data = [("20260101_00", 1.0, 5), ("20260101_00", 2.0, None), ("20260101_00", 3.0, 4)]
    table.upsert(spark.createDataFrame(data, "row_key STRING, v DOUBLE, seq BIGINT"), 0)
    assert rows(table.latest()) == [("20260101_00", 1.0, 5)]
    assert "SortAggregate" not in table.latest()._jdf.queryExecution().executedPlan().toString()


def test_reading_an_unwritten_table_says_so(table):
    with pytest.raises(ValueError, match="nothing was written"):
        table.latest()


def test_retention(spark, rows):
    now = datetime(2026, 1, 8)
    data = [(h, now - timedelta(hours=h)) for h in (1, 24, 25, 48, 49, 168, 169)]
    df = spark.createDataFrame(data, "h INT, ts TIMESTAMP").withColumn("dt", F.date_format("ts", "yyyyMMdd"))
    kept = {
        feed: [r["h"] for r in retained(df, feed, str(now)).collect()]
        for feed in ("vehicles", "weather")
    }
    assert kept == {"vehicles": [1, 24], "weather": [1, 24, 25, 48]}
    week = retained(df, "decisions", str(now), partition="dt")
    assert [r["h"] for r in week.collect()] == [1, 24, 25, 48, 49, 168]


DECISION = (
    "decision_id STRING, traffic_score DOUBLE, weather_score DOUBLE, sentiment_score DOUBLE,"
    " global_score DOUBLE, decision_result STRING, campaign_type STRING, targets ARRAY<STRING>,"
    " decision_time TIMESTAMP, display_time TIMESTAMP, seq BIGINT"
)


def decisions(spark, *ids, score=0.7):
    made = []
    for seq, key in enumerate(ids):
        at = datetime.strptime(key, "%Y%m%d_%H%M%S")
        made.append(
            (key, 0.9, 0.6, 0.5, score, "SHOW_AD", "ESCAPISM_NOW", ["1", "2"], at, at + timedelta(minutes=5), seq)
        )
    return spark.createDataFrame(made, DECISION)


IDS = ["20260108_135900", "20260108_140000", "20260108_143000", "20260109_000000"]


def test_archive_rows(spark):
    row = archive.archive_rows(decisions(spark, IDS[1])).first().asDict()
    assert row == {
        "decision_id": "20260108_140000",
        "traffic_score": 0.9,
        "weather_score": 0.6,
        "sentiment_score": 0.5,
        "global_score": 0.7,
        "decision_result": "SHOW_AD",
        "target_locations": "['1', '2']",
        "decision_time": "2026-01-08 14:00:00",
        "display_time": "2026-01-08 14:05:00",
        "dt": "20260108",
        "hr": "14",
    }


def ids(df):
    return sorted(r["decision_id"] for r in df.select("decision_id").collect())


def test_increments_neither_lose_nor_repeat(spark, tmp_path):
    path = str(tmp_path / "archive")
    rows = decisions(spark, *IDS)
    archive.archive_increment(spark, rows, path, "20260108_140000")
    assert ids(archive.read(spark, path)) == IDS[:1]
    # This attempt writes, then dies before the mark moves.
    lost = rows.filter("decision_id >= '20260108_140000' AND decision_id < '20260108_143001'")
    archive.append(archive.archive_rows(lost), path, archive.high_water_mark(spark, f"{path}/_marks"))
    archive.archive_increment(spark, rows, path, "20260110_000000")
    assert ids(archive.read(spark, path)) == IDS
    archive.archive_increment(spark, rows, path, "20260111_000000")
    assert ids(archive.read(spark, path)) == IDS


def test_archive_keeps_one_row_per_decision(spark, tmp_path):
    path = str(tmp_path / "archive")
    twice = decisions(spark, IDS[0], score=0.1).unionByName(
        decisions(spark, IDS[0], score=0.9).withColumn("seq", F.lit(7).cast("bigint"))
    )
    archive.archive_increment(spark, twice, path, "20270101_000000")
    assert [r["global_score"] for r in archive.read(spark, path).collect()] == [0.9]


def test_archive_table(spark, tmp_path, rows):
    path = str(tmp_path / "archive")
    archive.archive_increment(spark, decisions(spark, *IDS[:3]), path, "20260109_000000")
    archive.create_table(spark, "archive_test", path)
    archive.refresh_partitions(spark, "archive_test")
    assert rows(archive.partitions(spark, "archive_test")) == [("20260108", "13"), ("20260108", "14")]
    archive.archive_increment(spark, decisions(spark, *IDS), path, "20260110_000000")
    archive.refresh_partitions(spark, "archive_test")
    spark.catalog.refreshTable("archive_test")
    assert len(rows(archive.partitions(spark, "archive_test"))) == 3
    stored = spark.table("archive_test")
    assert ids(archive.by_day(stored, "20260108")) == IDS[:3]
    hour = archive.by_hour(stored, "20260108", "14")
    assert [r["decision_id"] for r in hour.collect()] == ["20260108_143000", "20260108_140000"]
    plan = hour._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan
    assert "archive_test" in [t.name for t in spark.catalog.listTables()]
    kinds = {r["col_name"]: (r["data_type"], r["is_partition"]) for r in archive.describe(spark, "archive_test").collect()}
    assert kinds["global_score"] == ("double", False) and kinds["dt"] == ("string", True)


def test_publishing_is_ordered_across_files(spark, tmp_path):
    path = str(tmp_path / "topic")
    publish.publish(decisions(spark, *reversed(IDS)), path, format="json")
    parts = sorted(p for p in (tmp_path / "topic").glob("part-*"))
    keys = [r["key"] for p in parts for r in spark.read.schema("key STRING").json(str(p)).collect()]
    assert keys == IDS
    body = publish.payloads(decisions(spark, IDS[0])).first()["value"]
    assert body == (
        '{"decision_id":"20260108_135900","timestamp":"2026-01-08T13:59:00",'
        '"display_time":"2026-01-08 14:04:00","decision":"SHOW_AD",'
        '"metrics":{"global":0.7,"traffic":0.9,"weather":0.6,"sentiment":0.5},'
        '"action":{"show_ad":true,"campaign":"ESCAPISM_NOW","targets":["1","2"]}}'
    )


def test_csv_survives_quotes_and_line_breaks(spark, tmp_path, rows):
    df = spark.createDataFrame([('say "no"\nand, then', 1.5)], "text STRING, x DOUBLE")
    layers.export_csv(df, str(tmp_path / "csv"))
    assert rows(layers.import_csv(spark, str(tmp_path / "csv"), df.schema)) == rows(df)


@pytest.mark.parametrize("format", ["orc", "csv"])
def test_batch_layer_folders(spark, tmp_path, format):
    df = spark.createDataFrame(
        [("2025-11-17T14:00", 4.5, 0.0, 85), ("2025-11-18T15:00", 3.8, 1.2, 100)],
        "forecast_time STRING, temp_2m DOUBLE, rain DOUBLE, cloud_cover INT",
    )
    layer = layers.weather_layer(df, F.substring("forecast_time", 1, 10))
    path = layers.write_layer(layer, str(tmp_path), "weather", format)
    assert sorted(p.name for p in (tmp_path / "weather").glob("date=*")) == [
        "date=2025-11-17",
        "date=2025-11-18",
    ]
    assert path.endswith("/weather")


def test_latest_state(spark):
    df = spark.createDataFrame(
        [
            ("Centrum", "20260101_000000", 0.9, 0.1, 0.4, "SHOW_AD"),
            ("Centrum", "20260101_000100", 0.1, 0.7, 0.4, "NO_AD"),
        ],
        "area STRING, decision_id STRING, traffic_score DOUBLE, weather_score DOUBLE,"
        " sentiment_score DOUBLE, decision_result STRING",
    )
    assert tuple(latest_state(df).first()) == (
        "Centrum",
        "20260101_000100",
        "LOW",
        "HIGH",
        "MEDIUM",
        False,
    )


def test_numbers_alone_are_compared_without_sorting(spark, rows):
    df = spark.createDataFrame([("a", 1, 5.0), ("a", 3, None), ("b", 2, 7.0)], "k STRING, seq BIGINT, x DOUBLE")
    latest = latest_per_key(df, "k", ["seq"])
    assert rows(latest) == [("a", 3, None), ("b", 2, 7.0)]
    assert "SortAggregate" not in latest._jdf.queryExecution().executedPlan().toString()


def test_backfill_of_many_hours_with_a_crowded_one(spark, tmp_path, rows):
    start = datetime(2026, 1, 1)
    times = [start + timedelta(hours=h) for h in range(60)]
    times += [start + timedelta(hours=30, seconds=s) for s in range(1, 1200)]
    made = [(f"{t:%Y%m%d_%H%M%S}", t, t, i) for i, t in enumerate(times)]
    df = spark.createDataFrame(
        made, "decision_id STRING, decision_time TIMESTAMP, display_time TIMESTAMP, seq BIGINT"
    )
    for score in ("traffic_score", "weather_score", "sentiment_score", "global_score"):
        df = df.withColumn(score, F.lit(0.5))
    df = df.withColumn("decision_result", F.lit("NO_AD")).withColumn(
        "targets", F.array().cast("array<string>")
    )
    path = str(tmp_path / "archive")
    archive.archive_increment(spark, df, path, "20270101_000000")
    stored = archive.read(spark, path)
    assert ids(stored) == sorted(m[0] for m in made)
    assert stored.select("dt", "hr").distinct().count() == 60
    crowded = list((tmp_path / "archive/dt=20260102/hr=06").glob("run=*/part-*.parquet"))
    assert len(crowded) > 1


def test_latest_of_numbers_hashes_and_leaves_strings_unread(spark, tmp_path):
    rows = [("20240101_000000_7_a", 1, "x", 2.0), ("20240101_000000_7_a", 2, "y", None), ("20240101_000001", 1, "z", 3.0)]
    table = KeyedTable(spark, str(tmp_path / "t"))
    table.upsert(spark.createDataFrame(rows, "row_key string, seq long, name string, v double"), 0)
    got = table.latest("v", (F.col("v") * 2).alias("w"))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "name" not in plan
    got = got.withColumn("vehicle", keys.key_vehicle(F.col("row_key"))).orderBy("row_key")
    assert [tuple(r) for r in got.collect()] == [
        ("20240101_000000_7_a", 2, None, None, "7_a"),
        ("20240101_000001", 1, 3.0, 6.0, None),
    ]
