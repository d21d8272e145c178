"""Reports from partial aggregates that grow with the archive.

One row an archived hour holds, for every decision value, the number of decisions and the sums from which
counts, means, deviations, extremes and correlations of the scores follow. An archive run
refreshes the hours it touched, reading those alone; the row of an hour is replaced as a whole, so repeated runs
and rewritten hours count once. Reports read the partials, some hundred bytes an hour, and never the archive.

Archived scores are never null (``scans.with_defaults``). Sums are taken of scores less ``CENTRE``, around
which they lie, so that squares keep their precision over many rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from citysignal import config as C
from citysignal.operators.store import KeyedTable
from citysignal.plans import archive
from citysignal.schemas import SCORES

CENTRE = 0.5
PAIRS = tuple(combinations_with_replacement(SCORES, 2))


def table(spark: SparkSession, path: str) -> KeyedTable:
    return KeyedTable(spark, path, key="row_key", order=["refreshed"])


def _centred(score: str) -> Column:
    return F.col(score) - F.lit(CENTRE)


def of_hours(rows: DataFrame) -> DataFrame:
    """Partials of archive rows: ``row_key`` (the hour) and ``parts``, one a decision value."""
    sums = [F.sum(_centred(s)).alias(f"sum_{s}") for s in SCORES]
    squares = [F.sum(_centred(a) * _centred(b)).alias(f"sum_{a}_{b}") for a, b in PAIRS]
    ends = [f(s).alias(f"{f.__name__}_{s}") for s in SCORES for f in (F.min, F.max)]
    by_result = rows.groupBy("dt", "hr", "decision_result").agg(
        F.count("*").alias("n"), *sums, *squares, *ends
    )
    names = [name for name in by_result.columns if name not in ("dt", "hr")]
    return by_result.groupBy(F.concat_ws("_", "dt", "hr").alias("row_key")).agg(
        F.collect_list(F.struct(*names)).alias("parts")
    )


def refresh(
    spark: SparkSession, archived: str, path: str, start: str, stop: str, batch_id: int
) -> None:
    """Bring the partials of the hours from key ``start`` to key ``stop`` up to date.

    Hours that lost all their decisions are emptied. ``batch_id`` numbers the refreshes.
    """
    first, last = start[:11], stop[:11]
    rows = archive.read(spark, archived)
    slot = F.concat_ws("_", "dt", "hr")
    inside = F.col("dt").between(first[:8], last[:8]) & slot.between(first, last)
    fresh = of_hours(rows.filter(inside))
    kept = table(spark, path)
    if kept.log() is not None:
        known = kept.latest().filter(F.col("row_key").between(first, last)).select("row_key")
        fresh = known.join(fresh, "row_key", "full")
        nothing = F.array().cast(fresh.schema["parts"].dataType)
        fresh = fresh.withColumn("parts", F.coalesce("parts", nothing))
    kept.upsert(fresh.withColumn("refreshed", F.lit(batch_id).cast("bigint")), batch_id)


def archive_increment(
    spark: SparkSession, decisions: DataFrame, archived: str, path: str, stop: str
) -> None:
    """An archive run, and the partials of its hours.

    A run that ended between the two is made up for: the refresh begins at the mark of the
    partials, which moves last.
    """
    done = archive.high_water_mark(spark, f"{path}/_marks")
    archive.archive_increment(spark, decisions, archived, stop)
    count = 0 if done == archive.FIRST_KEY else spark.read.parquet(f"{path}/_marks").count()
    refresh(spark, archived, path, done, stop, count)
    mark = spark.range(1).select(F.lit(done).alias("start"), F.lit(stop).alias("stop"))
    mark.write.mode("append").parquet(f"{path}/_marks")


def read(spark: SparkSession, path: str) -> DataFrame:
    """All partials: ``dt``, ``hr`` and the columns of a part."""
    parts = table(spark, path).latest().select("row_key", F.inline("parts"))
    hour = F.split("row_key", "_")
    return parts.select(hour[0].alias("dt"), hour[1].alias("hr"), *parts.columns[1:])


# --- Reports: the names and columns of ``plans.reports`` ------------------------------


def _total(name: str) -> Column:
    return F.sum(name).cast("double")


def _n() -> Column:
    return F.sum("n")


def _mean(score: str) -> Column:
    return _total(f"sum_{score}") / _n() + F.lit(CENTRE)


def _spread(a: str, b: str) -> Column:
    """Sum of the products of the distances from the means."""
    return _total(f"sum_{a}_{b}") - _total(f"sum_{a}") * _total(f"sum_{b}") / _n()


def _deviation(score: str) -> Column:
    variance = F.greatest(_spread(score, score), F.lit(0.0)) / (_n() - 1)
    return F.when(_n() > 1, F.sqrt(variance))


def _shown() -> Column:
    return F.coalesce(F.sum(F.when(F.col("decision_result") == C.SHOW_AD, F.col("n"))), F.lit(0))


def _rate() -> Column:
    return _shown() * F.lit(100.0) / _n()


def decision_distribution(parts: DataFrame) -> DataFrame:
    return parts.groupBy("decision_result").agg(
        _n().alias("decisions"), _mean("global_score").alias("avg_score")
    )


def show_rate(parts: DataFrame) -> DataFrame:
    return parts.agg(F.coalesce(_n(), F.lit(0)).alias("total"), _rate().alias("show_rate_pct"))


def daily_show_rate(parts: DataFrame) -> DataFrame:
    return (
        parts.groupBy("dt")
        .agg(
            _n().alias("total"),
            _shown().alias("shown"),
            F.round(_rate(), 2).alias("show_rate_pct"),
        )
        .orderBy(F.desc("dt"))
    )


def rush_vs_offpeak(parts: DataFrame, rush_hours: Sequence[int] = C.RUSH_HOURS) -> DataFrame:
    rush = F.col("hr").isin(*[f"{hour:02d}" for hour in rush_hours])
    period = F.when(rush, F.lit("Rush Hour")).otherwise(F.lit("Off-Peak")).alias("period")
    return parts.groupBy(period).agg(
        *[_mean(f"{part}_score").alias(f"avg_{part}") for part in ("traffic", "weather", "global")]
    )


def summary_by_decision(parts: DataFrame) -> DataFrame:
    moments = [
        make(score).alias(f"{name}_{score}")
        for score in SCORES
        for name, make in (("avg", _mean), ("std", _deviation))
    ]
    grouped = parts.groupBy("decision_result").agg(_n().alias("decisions"), *moments)
    # Runs over the aggregated rows only, one per decision value.
    everything = F.sum("decisions").over(Window.partitionBy())
    return grouped.withColumn("pct", F.col("decisions") * F.lit(100.0) / everything)


def score_correlation(parts: DataFrame, scores: Sequence[str] = SCORES) -> DataFrame:
    """Pearson matrix in long form."""
    pairs = [(a, b) for a, b in PAIRS if a != b]
    once = parts.agg(
        *[
            (_spread(a, b) / F.sqrt(_spread(a, a) * _spread(b, b))).alias(f"{a}|{b}")
            for a, b in pairs
        ]
    )

    def cell(a: str, b: str) -> Column:
        name = f"`{a}|{b}`" if (a, b) in pairs else f"`{b}|{a}`"
        value = F.lit(1.0) if a == b else F.col(name)
        return F.struct(F.lit(a).alias("score_a"), F.lit(b).alias("score_b"), value.alias("corr"))

    return once.select(F.inline(F.array(*[cell(a, b) for a in scores for b in scores])))


def hourly_pattern(parts: DataFrame) -> DataFrame:
    averages = [_mean(score).alias(f"avg_{score}") for score in SCORES]
    return (
        parts.groupBy("hr")
        .agg(_n().alias("decisions"), *averages, _rate().alias("show_rate_pct"))
        .orderBy("hr")
    )


def top_days(parts: DataFrame, n: int = 5) -> DataFrame:
    return (
        parts.groupBy("dt")
        .agg(
            _mean("global_score").alias("avg_score"),
            F.max("max_global_score").alias("max_score"),
            _n().alias("decisions"),
        )
        .orderBy(F.desc("avg_score"), "dt")
        .limit(n)
    )
