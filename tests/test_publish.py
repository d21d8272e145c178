"""Each topic partition is written by one task, in key order."""

from pyspark.sql import functions as F

from citysignal.sinks import publish
from test_partials import decisions


def test_partitions_are_whole_and_in_order(spark, tmp_path):
    made = decisions(spark).withColumns(
        {"campaign_type": F.lit(""), "targets": F.array(F.lit("1")), "decision_time": F.current_timestamp(), "display_time": F.current_timestamp()}
    )
    for partitions in (1, 5):
        path = str(tmp_path / str(partitions))
        publish.publish(made.repartition(7), path, format="parquet", partitions=partitions)
        files = {}
        for file in spark.read.parquet(path).inputFiles():
            for r in spark.read.parquet(file).collect():
                files.setdefault(r.partition, []).append((file, r.key))
        assert set(files) == set(range(partitions))
        for rows in files.values():
            assert len({f for f, _ in rows}) == 1 and [k for _, k in rows] == sorted(k for _, k in rows)
        assert sum(map(len, files.values())) == 400
