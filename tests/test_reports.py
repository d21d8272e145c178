import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from citysignal.operators import quantiles
from citysignal.operators.quantiles import exact_quantiles
from citysignal.plans import reports
from citysignal.schemas import SCORES


def groups(spark, **values):
    data = [(g, float(x)) for g, xs in values.items() for x in xs]
    return spark.createDataFrame(data, "g STRING, x DOUBLE")


def found(df):
    return {(r["g"], r["prob"]): r["quantile"] for r in df.collect()}


PROBS = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]


def check(spark, **values):
    got = found(exact_quantiles(groups(spark, **values), ["g"], PROBS))
    for g, xs in values.items():
        want = np.quantile(np.array(xs, dtype=float), PROBS)
        assert [got[(g, p)] for p in PROBS] == pytest.approx(list(want), rel=1e-12, abs=1e-12)


def test_quantiles_of_uneven_groups(spark):
    rng = np.random.default_rng(1)
    check(
        spark,
        hot=np.concatenate([np.full(3000, 0.25), rng.random(2000)]),
        tiny=[3.0],
        pair=[1.0, 2.0],
        same=[7.0] * 50,
        # Needs several passes: almost everything falls into one bucket at first.
        far=np.concatenate([rng.random(500) * 1e-9, [1e9, -1e9]]),
    )


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e6, 1e6, allow_subnormal=False), min_size=1, max_size=60))
def test_quantiles_match_numpy(spark, xs):
    check(spark, a=xs)


def test_large_span_tables_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "BROADCAST_SPANS", 0)
    check(spark, a=[1.0, 2.0, 5.0, 9.0], b=[4.0, 4.0, 8.0])


def test_nulls_and_nans_are_ignored(spark):
    df = spark.createDataFrame([("g", 1.0), ("g", None), ("g", float("nan")), ("g", 3.0)], "g STRING, x DOUBLE")
    assert found(exact_quantiles(df, ["g"], [0.5])) == {("g", 0.5): 2.0}


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(7)
    n = 400
    parts = rng.random((n, 3)).round(3)
    score = parts @ [0.4, 0.4, 0.2]
    day = rng.integers(1, 5, n)
    hour = rng.integers(0, 24, n)
    return pd.DataFrame(
        {
            "decision_id": [f"202601{d:02d}_{h:02d}{i:04d}" for i, (d, h) in enumerate(zip(day, hour))],
            "traffic_score": parts[:, 0],
            "weather_score": parts[:, 1] ** 4,
            "sentiment_score": parts[:, 2],
            "global_score": score,
            "decision_result": np.where(score > 0.5, "SHOW_AD", "NO_AD"),
            "decision_time": "",
            "dt": [f"202601{d:02d}" for d in day],
            "hr": [f"{h:02d}" for h in hour],
        }
    )


@pytest.fixture(scope="module")
def archive(spark, frame):
    return spark.createDataFrame(frame)


def test_describe(archive, frame):
    want = frame[list(SCORES)].describe()
    names = {"n": "count", "mean": "mean", "std": "std", "min": "min", "q25": "25%", "q50": "50%", "q75": "75%", "max": "max"}
    for row in reports.describe_scores(archive).collect():
        for ours, theirs in names.items():
            assert row[ours] == pytest.approx(want.loc[theirs, row["score"]])


def test_histogram(archive, frame):
    got = reports.score_histogram(archive).orderBy("score", "bin").toPandas()
    for score in SCORES:
        mine = got[got.score == score]
        counts, edges = np.histogram(frame[score], bins=20)
        assert mine.n.tolist() == counts.tolist()
        assert mine.bin_lo.tolist() == pytest.approx(edges[:-1].tolist())
        assert mine.bin_hi.tolist() == pytest.approx(edges[1:].tolist())
        assert mine["median"].iloc[0] == pytest.approx(frame[score].median())


def test_histogram_edges_and_flat_scores(spark):
    xs = [i / 20 for i in range(21)] + [0.15, 0.35]
    df = spark.createDataFrame([(x, 0.5, 0.5, 0.5) for x in xs], ", ".join(f"{s} DOUBLE" for s in SCORES))
    got = reports.score_histogram(df).orderBy("score", "bin").toPandas()
    for score, values in (("traffic_score", xs), ("weather_score", [0.5] * len(xs))):
        counts, _ = np.histogram(values, bins=20)
        assert got[got.score == score].n.tolist() == counts.tolist()


def test_boxplot(archive, frame):
    for row in reports.score_boxplot(archive).collect():
        xs = frame.loc[frame.decision_result == row["decision_result"], row["score"]]
        q1, q2, q3 = xs.quantile([0.25, 0.5, 0.75])
        inside = xs[(xs >= q1 - 1.5 * (q3 - q1)) & (xs <= q3 + 1.5 * (q3 - q1))]
        assert (row["q25"], row["q50"], row["q75"]) == pytest.approx((q1, q2, q3))
        assert (row["whisker_low"], row["whisker_high"]) == pytest.approx((inside.min(), inside.max()))
        assert row["outliers"] == len(xs) - len(inside)


def test_correlations(archive, frame):
    want = frame[list(SCORES)].corr()
    got = reports.score_correlation(archive).collect()
    assert len(got) == 16
    for row in got:
        assert row["corr"] == pytest.approx(want.loc[row["score_a"], row["score_b"]])
    order = [r["score"] for r in reports.corr_with_global(archive).collect()]
    assert order == want["global_score"].sort_values(ascending=False).index.tolist()


def test_summary(archive, frame):
    for row in reports.summary_by_decision(archive).collect():
        part = frame[frame.decision_result == row["decision_result"]]
        assert row["decisions"] == len(part)
        assert row["pct"] == pytest.approx(100 * len(part) / len(frame))
        for score in SCORES:
            assert row[f"avg_{score}"] == pytest.approx(part[score].mean())
            assert row[f"std_{score}"] == pytest.approx(part[score].std())


def test_rates(archive, frame):
    shown = frame.decision_result == "SHOW_AD"
    assert reports.show_rate(archive).first()["show_rate_pct"] == pytest.approx(100 * shown.mean())
    daily = reports.daily_show_rate(archive).collect()
    assert [r["dt"] for r in daily] == sorted(frame.dt.unique(), reverse=True)
    for row in daily:
        assert row["show_rate_pct"] == pytest.approx(100 * shown[frame.dt == row["dt"]].mean(), abs=0.005)
    days = reports.most_triggered_days(archive).collect()
    assert [r["shown"] for r in days] == sorted((r["shown"] for r in days), reverse=True)
    rush = frame.hr.isin(["07", "08", "09", "16", "17", "18"])
    for row in reports.rush_vs_offpeak(archive).collect():
        part = frame[rush if row["period"] == "Rush Hour" else ~rush]
        assert row["avg_global"] == pytest.approx(part.global_score.mean())
    hours = reports.hourly_pattern(archive).collect()
    assert [r["hr"] for r in hours] == sorted(frame.hr.unique())


def test_tops_and_overview(archive, frame):
    best = [r["global_score"] for r in reports.top_scores(archive).collect()]
    assert best == sorted(frame.global_score, reverse=True)[:10]
    days = reports.top_days(archive, 2).collect()
    want = frame.groupby("dt").global_score.mean().sort_values(ascending=False)
    assert [r["dt"] for r in days] == want.index[:2].tolist()
    overview = {r["column_name"]: r for r in reports.dataset_overview(archive).collect()}
    assert overview["dt"]["n_rows"] == len(frame) and overview["dt"]["data_type"] == "string"
    series = [r["decision_id"] for r in reports.score_timeseries(archive).collect()]
    assert series == sorted(frame.decision_id)
    assert reports.scatter_pairs(archive).count() == 3 * len(frame)
    assert {r["decision_result"]: r["decisions"] for r in reports.decision_distribution(archive).collect()} == (
        frame.decision_result.value_counts().to_dict()
    )


@pytest.fixture
def scans(spark):
    """A frame whose rows count themselves each time they are read."""
    counter = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def read(x):
        counter.add(1)
        return x

    def counting(df):
        return df.withColumn("traffic_score", read.asNondeterministic()("traffic_score"))

    return counting, counter


@pytest.mark.parametrize("report", [reports.describe_scores, reports.score_histogram, reports.score_boxplot])
def test_quantile_reports_scan_twice(spark, scans, report):
    counting, counter = scans
    rows = spark.range(0, 20_000, numPartitions=3).select(
        F.col("id").cast("string").alias("decision_id"),
        F.when(F.col("id") % 3 == 0, "SHOW_AD").otherwise("NO_AD").alias("decision_result"),
        *[(F.pmod(F.xxhash64("id", F.lit(i)), F.lit(100_003)) / 100_003).alias(s) for i, s in enumerate(reports.SCORES)],
    )
    stored = rows.cache()
    want = sorted(map(tuple, report(stored).collect()), key=repr)
    before = counter.value
    got = sorted(map(tuple, report(counting(stored)).collect()), key=repr)
    assert counter.value - before == 2 * stored.count() and got == want
    pdf = stored.toPandas()
    if report is reports.score_boxplot:
        by = {(r[0], r[1]): r for r in got}
        for (result, score), row in by.items():
            xs = pdf[pdf.decision_result == result][score]
            q1, q2, q3 = np.quantile(xs, [0.25, 0.5, 0.75])
            inside = xs[(xs >= q1 - 1.5 * (q3 - q1)) & (xs <= q3 + 1.5 * (q3 - q1))]
            assert row[2:7] == pytest.approx((q1, q2, q3, inside.min(), inside.max()))
            assert row[7] == len(xs) - len(inside)
    stored.unpersist()


def test_ranks_outside_their_span_are_found_in_the_rows(spark, monkeypatch):
    """Also with sketches that bound nothing."""
    monkeypatch.setattr(quantiles, "SKETCH_K", 8)
    monkeypatch.setattr(quantiles, "SLACK", -0.2)
    df = spark.range(5000).select(F.lit("g").alias("g"), F.pmod(F.xxhash64("id"), F.lit(977)).cast("double").alias("x"))
    want = df.toPandas().x.quantile([0.1, 0.5, 0.93])
    got = found(exact_quantiles(df, ["g"], [0.1, 0.5, 0.93]))
    assert [got["g", p] for p in (0.1, 0.5, 0.93)] == pytest.approx(list(want))


def test_whiskers_with_outliers(spark):
    xs = [0.0, 1.0, *[10 + i / 10 for i in range(40)], 30.0, 31.0]
    rows = spark.createDataFrame([("A", *[x] * 4) for x in xs], "decision_result STRING, " + ", ".join(f"{s} DOUBLE" for s in reports.SCORES))
    row = reports.score_boxplot(rows).first()
    assert (row.whisker_low, row.whisker_high, row.outliers) == (10.0, 13.9, 4)
