"""Late and corrected decisions, replayed streams, and order by the source."""

from pyspark.sql import functions as F

from citysignal.operators.store import KeyedTable
from citysignal.plans import archive
from citysignal.streaming import ingest
from test_partials import decisions


def kept(spark, path):
    return sorted(map(tuple, archive.read_base(spark, path).collect()), key=repr)


def test_only_hours_that_differ_are_rewritten(spark, tmp_path):
    path, straight = str(tmp_path / "a"), str(tmp_path / "b")
    rows = decisions(spark).withColumn("campaign_type", F.lit("c"))
    keys = [r[0] for r in rows.select("decision_id").orderBy("decision_id").collect()]
    stop = keys[300]
    archive.archive_increment(spark, rows, straight, stop)
    known = rows.filter(~F.col("decision_id").isin(keys[5], keys[250]))
    known = known.withColumn("campaign_type", F.when(F.col("decision_id") == keys[100], "other").otherwise("c"))
    extra = known.filter(F.col("decision_id") == keys[20]).withColumn("decision_id", F.lit(keys[20][:9] + "235959"))
    archive.archive_increment(spark, known.unionByName(extra), path, keys[150])
    archive.archive_increment(spark, known, path, stop)
    files = {f for f in spark.read.parquet(path).inputFiles()}
    want = {(keys[i][:8], keys[i][9:11]) for i in (5, 250, 100)} | {(keys[20][:8], "23")}
    assert set(archive.reconcile(spark, rows, path)) == want
    assert kept(spark, path) == kept(spark, straight)
    untouched = {f for f in files if not any(f"dt={d}/hr={h}/" in f for d, h in want)}
    assert untouched and untouched <= set(spark.read.parquet(path).inputFiles())
    assert archive.reconcile(spark, rows, path) == []
    # Once more, over hours that were reconciled before.
    archive.reconcile(spark, known, path)
    assert archive.reconcile(spark, rows, path) and kept(spark, path) == kept(spark, straight)


def test_order_by_the_source_survives_a_slow_clock(spark, tmp_path, monkeypatch):
    for source_order, want in ((True, 2), (False, 1)):
        table = KeyedTable(spark, str(tmp_path / str(source_order)), order=["seq", "part"], source_order=source_order)
        new = spark.createDataFrame([("20260101_000000_a", 2, 0), ("20260101_000000_b", 2, 0)], "row_key string, seq long, part int")
        old = spark.createDataFrame([("20260101_000000_a", 1, 9)], new.schema)
        table.upsert(new, 0, "fast")
        table.upsert(old, 0, "replay")
        got = {r.row_key[-1]: r.seq for r in table.latest().collect()}
        assert got == {"a": want, "b": 2}


def test_a_second_delivery_adds_nothing(spark, tmp_path):
    inbox, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "id string, at timestamp, arrived long"
    for delivery in range(3):
        data = [(f"v{i}", i * 600) for i in range(40)]
        rows = spark.createDataFrame([(v, s, delivery) for v, s in data], "id string, s long, arrived long")
        rows = rows.select("id", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("s")).alias("at"), "arrived")
        rows.coalesce(1).write.mode("append").parquet(inbox)
        stream = spark.readStream.schema(schema).parquet(inbox)
        query = ingest.once(stream, ["id", "at"], "at", "1 hour").writeStream.format("parquet").outputMode("append")
        query.option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start(out).awaitTermination()
    got = spark.read.parquet(out)
    assert got.count() == 40 and {r.arrived for r in got.collect()} == {0}
