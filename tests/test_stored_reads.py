"""Reads that stored statistics keep short: keys, ordered heads, cells; and keyword tables."""

import random
import re

import pytest
from pyspark.sql import functions as F

from citysignal.functions import geo
from citysignal.functions.text import keyword_pattern
from citysignal.operators import cells, search
from citysignal.operators.store import KeyedTable


def scanned(df):
    """Files and rows that the scans of a frame read, once it has run."""
    plan = df._jdf.queryExecution().executedPlan()
    df._jdf.queryExecution().toRdd().count()
    found = {"numFiles": 0, "numOutputRows": 0}

    def walk(node):
        name = node.nodeName()
        if name.startswith("Scan parquet"):
            for metric in found:
                found[metric] += node.metrics().apply(metric).value()
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))
        if name == "AdaptiveSparkPlan":
            walk(node.executedPlan())
        elif name.endswith("QueryStage"):
            walk(node.plan())

    walk(plan)
    return found


@pytest.fixture
def table(spark, tmp_path):
    stored = KeyedTable(spark, str(tmp_path / "table"))
    for batch in range(3):
        key = F.date_format(F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 600 + batch), "yyyyMMdd_HHmmss")
        rows = spark.range(0, 3000, numPartitions=4).select(key.alias("row_key"), F.col("id").alias("seq"), F.lit(batch).alias("b"))
        stored.upsert(rows, batch)
    return stored


def test_get_reads_one_day_and_the_row_groups_of_the_key(spark, table):
    keys = [r.row_key for r in table.latest().select("row_key").orderBy("row_key").collect()]
    one = table.get(keys[4000])
    read = scanned(one)
    assert [r.row_key for r in one.collect()] == [keys[4000]]
    assert read["numFiles"] <= 3 and read["numOutputRows"] <= 3 * 144
    # A key inside the range of its day's files that none of them has: the Bloom filters refuse it.
    missing = keys[4000][:-1] + ("5" if not keys[4000].endswith("5") else "7")
    assert missing not in keys
    none = table.get(missing)
    assert scanned(none)["numOutputRows"] == 0 and none.count() == 0


def test_head_reads_the_first_days(spark, table):
    keys = [r.row_key for r in table.latest().select("row_key").orderBy("row_key").collect()]
    days = table.days()
    assert days == sorted({k[:8] for k in keys}) and len(days) > 15
    for n in (1, 5, 500, 20_000):
        assert [r.row_key for r in table.head(n).collect()] == keys[:n]
    table.changes().filter(F.col("dt") == days[-1]).count()
    # Only the first days are opened: the head works although the last day is damaged.
    last = [f for f in table.changes().inputFiles() if f"dt={days[-1]}" in f]
    for file in last:
        with open(file.removeprefix("file:").replace("///", "/"), "wb") as out:
            out.write(b"damaged")
    assert [r.row_key for r in table.head(5).collect()] == keys[:5]


def test_cells_find_what_the_radius_finds_and_read_less(spark, tmp_path):
    rng = random.Random(2)
    data = [(i, rng.uniform(50, 54), rng.uniform(19, 23)) for i in range(20_000)]
    data += [(90_000, None, 21.0), (90_001, 52.2297, 21.0122), (90_002, 90.0, 180.0), (90_003, -90.0, -180.0)]
    rows = spark.createDataFrame(data, "id long, lat double, lon double")
    path = str(tmp_path / "cells")
    cells.write(rows.repartition(3), path, row_group_bytes=20_000)
    stored = spark.read.parquet(path)
    for radius in (0.5, 20.0, 300.0):
        near = cells.within_radius(stored, radius_km=radius)
        want = {r.id for r in search.within_radius(rows, radius_km=radius).collect()}
        assert {r.id for r in near.collect()} == want and len(want) > 0
    small = scanned(cells.within_radius(stored))["numOutputRows"]
    plain = str(tmp_path / "plain")
    rows.repartition(3).write.option("parquet.block.size", 20_000).parquet(plain)
    assert small < scanned(search.within_radius(spark.read.parquet(plain)))["numOutputRows"] / 3


@pytest.mark.parametrize("centre", [(52.2, 21.0), (-33.9, 151.2), (0.0, 0.0), (89.9, 10.0), (10.0, 179.99)])
def test_ranges_cover_the_circle(spark, centre):
    ranges = cells.ranges_of(geo.bounding_box(*centre, 25.0))
    assert len(ranges) <= 2 * cells.RANGES and all(a <= b for a, b in ranges)
    rng = random.Random(4)
    points = [(max(-90.0, min(90.0, centre[0] + rng.uniform(-0.3, 0.3))), centre[1] + rng.uniform(-0.4, 0.4)) for _ in range(500)]
    points = [(a, (b + 180) % 360 - 180) for a, b in points]
    rows = spark.createDataFrame(points, "lat double, lon double").withColumn(cells.CELL, cells.cell(F.col("lat"), F.col("lon")))
    near = search.within_radius(rows, centre, 25.0)
    inside = cells.in_cells(rows, centre, 25.0)
    assert near.filter(~inside).count() == 0 < near.count()


@pytest.mark.parametrize("broadcast_words", [1_000_000, 0])
def test_keyword_tables_match_like_patterns(spark, broadcast_words):
    rng = random.Random(7)
    syllables = ["ka", "lo", "mi", "ü", "1", "que", "la"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randrange(1, 3)))
    keywords = {" ".join(word() for _ in range(rng.randrange(1, 3))) for _ in range(60)}
    keywords |= {"1 1", "#tag", "c++", "a.b", "que la", "QUE", r"x\E y", "!!"}
    texts = [" ".join(rng.choice([word(), word(), ",", "#tag", "c++", "a.b"]) for _ in range(30)) for _ in range(60)]
    texts += ["11 1 1", "QUE LA", "", None, r"X\E Y", "aXb", "a#tag", "!!", texts[0]]
    posts = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    listed = spark.createDataFrame([(k,) for k in [*keywords, *keywords]], "keyword string")
    got = {r.id: r.keywords for r in search.with_keyword_table(posts, listed, broadcast_words=broadcast_words).collect()}
    python = {k.lower(): re.compile(keyword_pattern([k]).replace(r"[^\p{L}\p{N}]", r"[\W_]")) for k in keywords if k != "!!"}
    want = {i: sorted(k for k, p in python.items() if p.search(t.lower())) for i, t in enumerate(texts) if t}
    assert got == {i: k for i, k in want.items() if k}


def test_ten_thousand_keywords(spark):
    posts = spark.range(300).select("id", F.concat(F.lit("about w"), F.col("id") * 100, F.lit(" x and more")).alias("text"))
    keywords = spark.range(10_000).select(F.concat(F.lit("w"), F.col("id"), F.when(F.col("id") % 200 == 0, " x").otherwise("")).alias("keyword"))
    found = search.with_keyword_table(posts, keywords)
    assert found.count() == 100


def test_plain_keywords_that_share_a_word_are_not_tested_on_texts(spark, monkeypatch):
    """Keywords of few words are met by all of them, so a common first word costs nothing."""
    refuse = lambda text, keyword: F.raise_error(F.concat(F.lit("tested: "), keyword)).cast("boolean")
    monkeypatch.setattr(search.text_functions, "mentions", refuse)
    posts = spark.createDataFrame([(1, "The end, the w7  and the w8 end"), (2, "the, w9")], "id long, text string")
    keywords = spark.range(2000).select(F.concat(F.lit("the w"), F.col("id")).alias("keyword"))
    found = {r.id: r.keywords for r in search.with_keyword_table(posts, keywords).collect()}
    assert found == {1: ["the w7", "the w8"]}


@pytest.mark.parametrize("broadcast_words", [1_000_000, 0])
def test_long_and_punctuated_keywords_are_tested_behind_their_first_words(spark, broadcast_words):
    posts = spark.createDataFrame([(1, "a b c d e, f"), (2, "a b c e"), (3, "a  b c d e"), (4, "a b")], "id long, text string")
    keywords = spark.createDataFrame([("a b c d e",), ("a b!",), ("e, f",), ("(a b c",)], "keyword string")
    found = search.with_keyword_table(posts, keywords, broadcast_words=broadcast_words)
    assert {r.id: r.keywords for r in found.collect()} == {1: ["a b c d e", "e, f"]}
