"""Decisions made inside one streaming query equal those of the batch plan."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from citysignal.plans.decisions import decision_plan
from citysignal.sources.envelopes import read_table_stream
from citysignal.streaming import windows
from test_traffic import SCHEMA

T0 = datetime(2026, 1, 1, 8)
MOODS = "ts TIMESTAMP, sentiment_score INT"


def drives(seed, n=400, minutes=90):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        second = rng.randrange(60 * minutes)
        vehicle = rng.choice("abcdefghijklmnopqrstuvwxyz")
        out.append((vehicle, T0 + timedelta(seconds=second), 52 + second * 1e-5 + rng.random() / 2000, 21.0, i))
    return sorted(out, key=lambda r: r[1])


def forecast_of(spark):
    rows = [(f"20260101_{h:02d}", None, -2.0, 3.0, 0.0, 0.0, 12.0, 61, "x") for h in range(6, 12)]
    return spark.createDataFrame(
        rows, "row_key string, temp_2m double, apparent_temp double, rain double, snowfall double, snow_depth double, wind_speed double, weather_code int, note string"
    )


def in_files(spark, path, data, schema, files=4):
    size = -(-len(data) // files)
    for i in range(0, len(data), size):
        spark.createDataFrame(data[i : i + size], schema).coalesce(1).write.mode("append").parquet(path)


@pytest.mark.parametrize(
    ("length", "quiet"), [(None, None), ("10 minutes", "messages"), ("10 minutes", "vehicles")]
)
def test_stream_decides_like_batch(spark, tmp_path, rows, length, quiet):
    """Also while one of the streams has nothing to say for half of the time."""
    drive, half = drives(3), T0 + timedelta(minutes=45)
    talk = [(T0 + timedelta(seconds=61 * i), i % 10) for i in range(90)]
    sources = {"reports": (drive, SCHEMA), "talk": (talk, MOODS)}
    streams = {}
    for name, (data, schema) in sources.items():
        in_files(spark, str(tmp_path / name), data, schema)
        stream = read_table_stream(spark, str(tmp_path / name), schema, max_files=1)
        streams[name] = stream.withWatermark("ts", "10 minutes")
    batch = {name: spark.createDataFrame(data, schema) for name, (data, schema) in sources.items()}
    silent = {"messages": "talk", "vehicles": "reports"}.get(quiet)
    for frames in (streams, batch):
        if silent:
            frames[silent] = frames[silent].filter(F.col("ts") < half)
    made = windows.stream_decisions(streams["reports"], streams["talk"], forecast_of(spark), length, lateness=None)
    out = str(tmp_path / "out")
    mark = windows.run_to_files(made, out, str(tmp_path / "check"))
    closed = datetime.fromisoformat(mark.removesuffix("Z")).replace(tzinfo=None)
    want = decision_plan(batch["reports"], batch["talk"], forecast_of(spark), length=length)
    seen = [ts for _, ts, *_ in drive] + [ts for ts, _ in talk]
    last = max(ts for ts in seen if ts <= closed)
    # The batch plan also decides where only the forecast has data.
    want = want.filter((F.col("decision_time") <= closed) & (F.col("decision_time") > T0) & (F.col("decision_time") <= last))
    got = spark.read.parquet(out)
    assert rows(got.filter(F.col("decision_time") <= last)) == rows(want) and got.count() >= 4
