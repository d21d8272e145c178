"""Reports from partials: kept by increments, replaced by hours, never read from the archive."""

import pytest
from pyspark.sql import functions as F

from citysignal.plans import archive, partials, reports
from citysignal.schemas import SCORES

PAIRED = ["decision_distribution", "show_rate", "daily_show_rate", "rush_vs_offpeak", "summary_by_decision", "score_correlation", "hourly_pattern", "top_days"]


def decisions(spark, n=400, shift=0.0, hours=200):
    key = F.date_format(F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * (hours * 9)), "yyyyMMdd_HHmmss")
    score = [(F.pmod(F.xxhash64("id", F.lit(i)), F.lit(1009)) / 1009 + shift).alias(s) for i, s in enumerate(SCORES)]
    return spark.range(n).select(
        key.alias("decision_id"),
        *score,
        F.when(F.col("id") % 4 == 0, "SHOW_AD").otherwise("NO_AD").alias("decision_result"),
        F.lit("[]").alias("target_locations"),
        F.lit("").alias("decision_time"),
        F.lit("").alias("display_time"),
        F.col("id").alias("seq"),
    )


def agree(spark, archived, path):
    parts, rows = partials.read(spark, path), archive.read(spark, archived)
    for name in PAIRED:
        got = [tuple(r) for r in getattr(partials, name)(parts).collect()]
        want = getattr(reports, name)(rows)
        want = [tuple(r) for r in want.select(*getattr(partials, name)(parts).columns).collect()]
        for a, b in zip(sorted(got, key=repr), sorted(want, key=repr), strict=True):
            assert a == pytest.approx(b), name


def test_partials_follow_the_archive(spark, tmp_path):
    archived, path = str(tmp_path / "archive"), str(tmp_path / "hours")
    rows = decisions(spark)
    keys = [r[0] for r in rows.select("decision_id").orderBy("decision_id").collect()]
    for stop in (keys[90], keys[91], keys[250], "99990101_000000"):
        partials.archive_increment(spark, rows, archived, path, stop)
    agree(spark, archived, path)
    assert partials.show_rate(partials.read(spark, path)).first()["total"] == 400
    # A rewritten archive hour replaces its partials; an emptied one is forgotten.
    day = keys[10][:8]
    archive.append(archive.archive_rows(decisions(spark, 1), campaign=True).limit(0), archived, "x")
    changed = archive.archive_rows(decisions(spark, shift=0.25), campaign=True).filter(F.col("dt") == day)
    archive.append(changed, archived, archive.FIRST_KEY)
    partials.refresh(spark, archived, path, f"{day}_000000", f"{day}_235959", 9)
    agree(spark, archived, path)
    empty = str(tmp_path / "none")
    archive.append(archive.archive_rows(decisions(spark, 1), campaign=True), empty, "x")
    partials.refresh(spark, empty, path, f"{day}_000000", f"{day}_235959", 10)
    got = {r["dt"] for r in partials.daily_show_rate(partials.read(spark, path)).collect()}
    left = archive.read(spark, empty).filter(F.col("dt") == day).count()
    assert (day in got) == (left > 0) and len(got) > 3


def test_a_run_that_lost_its_partials_is_made_up_for(spark, tmp_path):
    archived, path = str(tmp_path / "archive"), str(tmp_path / "hours")
    rows = decisions(spark)
    keys = [r[0] for r in rows.select("decision_id").orderBy("decision_id").collect()]
    partials.archive_increment(spark, rows, archived, path, keys[100])
    archive.archive_increment(spark, rows, archived, keys[200])
    partials.archive_increment(spark, rows, archived, path, keys[300])
    agree(spark, archived, path)


def test_reports_do_not_read_the_archive(spark, tmp_path):
    archived, path = str(tmp_path / "archive"), str(tmp_path / "hours")
    partials.archive_increment(spark, decisions(spark), archived, path, "99990101_000000")
    for name in PAIRED:
        files = getattr(partials, name)(partials.read(spark, path)).inputFiles()
        assert files and all("/hours/" in f and "/archive/" not in f for f in files)
