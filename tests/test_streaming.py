from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from citysignal.operators import parse, sentiment, traffic
from citysignal.operators.store import KeyedTable
from citysignal.sources.envelopes import FILE_SCHEMA, envelopes, read_envelopes, read_table_stream
from citysignal.streaming import ingest, windows
from test_traffic import SCHEMA, random_reports

T0 = datetime(2026, 1, 1, 8)


def vehicle_message(vehicle, second, lat=52.0):
    at = T0 + timedelta(seconds=second)
    body = (
        f'{{"result":[{{"VehicleNumber":"{vehicle}","Time":"{at:%Y-%m-%d %H:%M:%S}",'
        f'"Lat":{lat},"Lon":21.0}}]}}'
    )
    return body, at


def vehicle_stream(spark, topic):
    messages = read_envelopes(spark, topic, format="json", options={"maxFilesPerTrigger": "1"})
    good, _ = parse.quarantine_vehicles(
        parse.parse_vehicles(messages, "bus", ingested_at=F.col("kafka_ts"))
    )
    return good.withColumn("seq", F.unix_micros("ingestion_timestamp"))


def send(spark, topic, *messages):
    df = spark.createDataFrame(list(messages), FILE_SCHEMA).coalesce(1)
    df.write.mode("append").json(topic)


def test_ingest_resumes_and_keeps_the_last_write(spark, tmp_path, rows):
    topic, check = str(tmp_path / "topic"), str(tmp_path / "check")
    table = KeyedTable(spark, str(tmp_path / "table"))
    send(spark, topic, vehicle_message("1", 0), vehicle_message("2", 0), ("{broken", T0))
    ingest.ingest_all(vehicle_stream(spark, topic), table, check)
    assert [r[0] for r in rows(table.latest(), "vehicle_number")] == ["1", "2"]
    send(spark, topic, vehicle_message("1", 0, lat=53.0), vehicle_message("3", 60))
    ingest.ingest_all(vehicle_stream(spark, topic), table, check)
    assert rows(table.latest(), "vehicle_number", "lat") == [("1", 53.0), ("2", 52.0), ("3", 52.0)]
    # Nothing new: no batch is written.
    before = table.log().count()
    ingest.ingest_all(vehicle_stream(spark, topic), table, check)
    assert table.log().count() == before


def test_replay_from_the_start_changes_nothing(spark, tmp_path, rows):
    topic = str(tmp_path / "topic")
    table = KeyedTable(spark, str(tmp_path / "table"))
    for second in range(3):
        send(spark, topic, vehicle_message("1", second), vehicle_message("2", 0, lat=52 + second))
    ingest.ingest_all(vehicle_stream(spark, topic), table, str(tmp_path / "c1"), "bus")
    first = rows(table.latest())
    ingest.ingest_all(vehicle_stream(spark, topic), table, str(tmp_path / "c2"), "bus")
    assert rows(table.latest()) == first and table.log().count() == 6


def test_a_fresh_checkpoint_is_another_writer(spark, tmp_path, rows):
    """What an earlier checkpoint wrote under the same batch id stays."""
    table = KeyedTable(spark, str(tmp_path / "table"))
    for i, vehicle in enumerate("12"):
        topic = str(tmp_path / f"topic{i}")
        send(spark, topic, vehicle_message(vehicle, 0))
        ingest.ingest_all(vehicle_stream(spark, topic), table, str(tmp_path / f"c{i}"))
    assert [r[0] for r in rows(table.latest(), "vehicle_number")] == ["1", "2"]


def test_empty_batches_are_skipped(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "table"))
    ingest.batch_writer(table)(spark.createDataFrame([], SCHEMA), 0)
    assert table.log() is None


def test_failed_batches_end_the_query(spark, tmp_path):
    topic = str(tmp_path / "topic")
    send(spark, topic, vehicle_message("1", 0))
    table = KeyedTable(spark, str(tmp_path / "table"), key="no_such_column")
    query = ingest.ingest(vehicle_stream(spark, topic), table, str(tmp_path / "c"), every=None)
    with pytest.raises(Exception, match="no_such_column"):
        query.awaitTermination()


def in_time_order(spark, path, data, files=4):
    data = sorted(data, key=lambda r: r[1])
    size = -(-len(data) // files)
    for i in range(0, len(data), size):
        spark.createDataFrame(data[i : i + size], SCHEMA).coalesce(1).write.mode("append").parquet(path)


@pytest.mark.parametrize("length", [None, "10 minutes"])
def test_stream_equals_batch_on_closed_windows(spark, tmp_path, length):
    data = random_reports(11, n=200)
    path = str(tmp_path / "reports")
    in_time_order(spark, path, data)
    stream = read_table_stream(spark, path, SCHEMA, max_files=1)
    out = str(tmp_path / "out")
    windows.run_to_files(windows.stream_traffic(stream, length), out, str(tmp_path / "c"))
    got = {r["window"]["start"]: r["traffic_score"] for r in spark.read.parquet(out).collect()}
    df = spark.createDataFrame(data, SCHEMA)
    batch = traffic.tumbling_traffic(df, length) if length else traffic.sliding_traffic(df)
    closed = max(ts for _, ts, *_ in data) - timedelta(minutes=10)
    want = {
        r["window"]["start"]: r["traffic_score"]
        for r in batch.collect()
        if r["window"]["end"] <= closed
    }
    assert want and got == want


def test_table_stream_takes_a_file_or_a_folder(spark, tmp_path):
    path = str(tmp_path / "folder.parquet")
    in_time_order(spark, path, random_reports(1, n=8), files=2)
    single = next((tmp_path / "folder.parquet").glob("part-*.parquet"))
    for source, n in ((path, 8), (str(single), 4)):
        out = str(tmp_path / f"out{n}")
        windows.run_to_files(read_table_stream(spark, source, SCHEMA), out, str(tmp_path / f"c{n}"))
        assert spark.read.parquet(out).count() == n


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    inbox, out, check = (str(tmp_path / p) for p in ("in", "out", "check"))

    def deliver(*minutes):
        data = [("v", T0 + timedelta(minutes=m), 0.0, 0.0, m) for m in minutes]
        spark.createDataFrame(data, SCHEMA).write.mode("append").parquet(inbox)
        counted = (
            spark.readStream.schema(SCHEMA)
            .parquet(inbox)
            .withWatermark("ts", "10 minutes")
            .groupBy(F.window("ts", "5 minutes").alias("window"))
            .agg(F.count("*").alias("n"))
        )
        return windows.run_to_files(counted, out, check)

    deliver(0, 1, 16)
    mark = deliver(3, 7, 40)
    assert mark.endswith(":30:00.000Z")
    deliver(21, 22)
    raw = spark.read.parquet(inbox)
    late = windows.late_rows(spark.read.parquet(out), raw, "5 minutes", until=mark)
    got = late.orderBy("window").collect()
    # 08:03 comes when 08:00-08:05 is final; 08:07 is still in time.
    assert [(r["window"]["start"].minute, r["on_time"], r["late"]) for r in got] == [
        (0, 2, 1),
        (5, 1, 0),
        (15, 1, 0),
        # All of this window came after it was final.
        (20, 0, 2),
    ]


def test_rain_and_congestion_streams_join(spark, tmp_path):
    reports_path, rain_path = str(tmp_path / "reports"), str(tmp_path / "rain")
    drive = [("a", 0, 0.0), ("a", 300, 0.005), ("b", 3600, 0.0), ("b", 3900, 0.005), ("z", 9000, 0.0)]
    spark.createDataFrame(
        [(v, T0 + timedelta(seconds=s), lat, 0.0, s) for v, s, lat in drive], SCHEMA
    ).write.parquet(reports_path)
    rain_schema = "ts TIMESTAMP, rain DOUBLE"
    wet = [(0, 0.0), (600, 2.5), (3600, 0.0), (9000, 1.0)]
    spark.createDataFrame([(T0 + timedelta(seconds=s), mm) for s, mm in wet], rain_schema).write.parquet(rain_path)
    joined = windows.stream_rain_congestion(
        read_table_stream(spark, reports_path, SCHEMA),
        read_table_stream(spark, rain_path, rain_schema),
        "1 hour",
    )
    out = str(tmp_path / "out")
    windows.run_to_files(joined, out, str(tmp_path / "c"))
    got = spark.read.parquet(out).collect()
    assert [(r["window"]["start"], r["rain"], r["congested"]) for r in got] == [(T0, 2.5, 1)]


def test_kafka_reader_is_asked_for_the_documented_options(spark):
    with pytest.raises(Exception, match="kafka"):
        read_envelopes(spark, "vehicles", servers="broker:9092")


def test_envelopes_decode_bytes(spark):
    df = spark.createDataFrame([(bytearray(b"{}"), T0)], "value BINARY, timestamp TIMESTAMP")
    assert tuple(envelopes(df).first()) == ("{}", T0)


LEXICON = [("good", 1.9), ("awful", -2.0), ("meh", -0.1)]


def scored(spark, broadcast_words):
    docs = spark.createDataFrame(
        [(1, "Good, GOOD day"), (2, "awful"), (3, ""), (4, None), (5, "plain text"), (6, "good awful meh meh")],
        "id INT, text STRING",
    )
    lexicon = spark.createDataFrame(LEXICON, "word STRING, valence DOUBLE")
    df = sentiment.score_text(docs, lexicon, id="id", broadcast_words=broadcast_words)
    return {r["id"]: (r["matches"], r["valence"], round(r["compound"], 4)) for r in df.collect()}


def test_lexicon_scores_are_the_same_with_and_without_broadcast(spark):
    want = {
        1: (2, 3.8, 0.7003),
        2: (1, -2.0, -0.4588),
        3: (0, 0.0, 0.0),
        4: (0, 0.0, 0.0),
        5: (0, 0.0, 0.0),
        6: (4, -0.3, -0.0772),
    }
    assert scored(spark, 100) == want and scored(spark, 2) == want


def test_own_scorer(spark):
    @F.pandas_udf("double")
    def shouting(texts: pd.Series) -> pd.Series:
        return texts.str.isupper().astype(float)

    docs = spark.createDataFrame([("HI",), ("hi",)], "text STRING")
    got = sentiment.bucketed(sentiment.score_with(docs, shouting)).orderBy("text").collect()
    assert [r["sentiment_score"] for r in got] == [9, 4]


def test_negative_share(spark):
    data = [(T0, 3), (T0 + timedelta(minutes=1), 4), (T0 + timedelta(minutes=2), None), (T0 + timedelta(hours=1), 0)]
    df = spark.createDataFrame(data, "ts TIMESTAMP, sentiment_score INT")
    got = sentiment.negative_share(df, "1 hour").orderBy("window").collect()
    assert [(r["tweets"], r["negative"]) for r in got] == [(3, 1), (1, 1)]
    assert got[0]["sentiment_ratio"] == pytest.approx(1 / 3)


def test_decidable_windows_are_final_in_both_streams(spark):
    def emitted(*hours):
        data = [((T0 + timedelta(hours=h), T0 + timedelta(hours=h + 1)), h) for h in hours]
        return spark.createDataFrame(data, "window STRUCT<start: TIMESTAMP, end: TIMESTAMP>, h INT")

    moving, moods = windows.decidable(emitted(0, 1, 2), emitted(0, 3))
    assert (moving.count(), [r["h"] for r in moods.collect()]) == (3, [0])
    moving, moods = windows.decidable(emitted(0, 1), emitted())
    assert (moving.count(), moods.count()) == (0, 0)
    # With watermarks a quiet stream holds nothing back.
    until = windows.earliest([f"{T0:%Y-%m-%dT%H:%M:%S}.000Z", None])
    assert until == windows.NOT_BEGUN
    until = f"{T0 + timedelta(hours=2):%Y-%m-%dT%H:%M:%S}.000Z"
    moving, moods = windows.decidable(emitted(0, 1, 2), emitted(), until)
    assert (moving.count(), moods.count()) == (2, 0)


def test_sliding_share_in_batch_and_on_a_stream(spark, tmp_path):
    data = [(T0 + timedelta(seconds=37 * i), i % 10) for i in range(100)]
    schema = "ts TIMESTAMP, sentiment_score INT"
    df = spark.createDataFrame(data, schema)
    want = {}
    for i, (ts, score) in enumerate(data):
        for back in range(10):
            start = ts.replace(second=0) - timedelta(minutes=back)
            tweets, negative = want.get(start, (0, 0))
            want[start] = (tweets + 1, negative + (score < 4))

    def found(rows):
        return {r["window"]["start"]: (r["tweets"], r["negative"]) for r in rows.collect()}

    assert found(sentiment.negative_share(df, "10 minutes", "1 minute")) == want
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    df.write.parquet(path)
    stream = read_table_stream(spark, path, schema)
    share = windows.stream_negative_share(stream, "10 minutes", "1 minute")
    windows.run_to_files(share, out, str(tmp_path / "c"))
    closed = data[-1][0] - timedelta(minutes=20)
    assert found(spark.read.parquet(out)) == {s: n for s, n in want.items() if s <= closed}


def test_windows_over_closed_steps_equal_those_of_the_stream(spark, tmp_path):
    """One state row a vehicle and step is enough: windows are made of the closed steps."""
    path = str(tmp_path / "reports")
    in_time_order(spark, path, random_reports(12, n=200))
    stream = read_table_stream(spark, path, SCHEMA, max_files=1)
    steps, out = windows.stream_steps(stream), str(tmp_path / "steps")
    until = windows.run_to_files(steps, out, str(tmp_path / "c"))
    got = windows.sliding_traffic_of(spark.read.parquet(out), until).collect()
    whole = str(tmp_path / "whole")
    windows.run_to_files(windows.stream_traffic(stream), whole, str(tmp_path / "d"))
    want = spark.read.parquet(whole).collect()
    key = lambda r: (r["window"]["start"], r["vehicles"], r["congested"], r["traffic_score"])
    assert want and sorted(map(key, got)) == sorted(map(key, want))
    once = spark.read.parquet(out).groupBy("window", "vn").count().filter("count > 1")
    assert once.count() == 0
