"""Reports over the decision archive."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citysignal import config as C
from citysignal.operators import quantiles
from citysignal.operators.joins import small_side
from citysignal.schemas import SCORES
from citysignal.session import cut_lineage

PARTS = SCORES[:3]
QUARTILES = (0.25, 0.5, 0.75)
BINS = 20


def _shown() -> Column:
    return F.col("decision_result") == C.SHOW_AD


def _rate() -> Column:
    """Share of shown decisions in percent."""
    return F.count_if(_shown()) * F.lit(100.0) / F.count("*")


def long_scores(archive: DataFrame, scores: Sequence[str] = SCORES, keep: Sequence[str] = ()):
    """One row ``(score, x)`` per decision and score."""
    return archive.unpivot([F.col(c) for c in keep], list(scores), "score", "x")


def decision_distribution(archive: DataFrame) -> DataFrame:
    return archive.groupBy("decision_result").agg(
        F.count("*").alias("decisions"), F.avg("global_score").alias("avg_score")
    )


def show_rate(archive: DataFrame) -> DataFrame:
    return archive.agg(F.count("*").alias("total"), _rate().alias("show_rate_pct"))


def daily_show_rate(archive: DataFrame) -> DataFrame:
    return (
        archive.groupBy("dt")
        .agg(
            F.count("*").alias("total"),
            F.count_if(_shown()).alias("shown"),
            F.round(_rate(), 2).alias("show_rate_pct"),
        )
        .orderBy(F.desc("dt"))
    )


def rush_vs_offpeak(archive: DataFrame, rush_hours: Sequence[int] = C.RUSH_HOURS) -> DataFrame:
    rush = F.col("hr").isin(*[f"{hour:02d}" for hour in rush_hours])
    period = F.when(rush, F.lit("Rush Hour")).otherwise(F.lit("Off-Peak")).alias("period")
    return archive.groupBy(period).agg(
        F.avg("traffic_score").alias("avg_traffic"),
        F.avg("weather_score").alias("avg_weather"),
        F.avg("global_score").alias("avg_global"),
    )


def summary_by_decision(archive: DataFrame) -> DataFrame:
    """Count, share and mean ± sample deviation of each score per decision."""
    moments = [
        make(score).alias(f"{name}_{score}")
        for score in SCORES
        for name, make in (("avg", F.avg), ("std", F.stddev_samp))
    ]
    grouped = archive.groupBy("decision_result").agg(F.count("*").alias("decisions"), *moments)
    # Runs over the aggregated rows only, one per decision value.
    everything = F.sum("decisions").over(Window.partitionBy())
    return grouped.withColumn("pct", F.col("decisions") * F.lit(100.0) / everything)


def describe_scores(archive: DataFrame) -> DataFrame:
    """Count, mean, deviation, extremes and quartiles of each score; two scans."""
    rows = long_scores(archive)
    base = quantiles.sketched(
        rows,
        ["score"],
        F.count("x").alias("n_filled"),
        F.avg("x").alias("mean"),
        F.stddev_samp("x").alias("std"),
        F.min("x").alias("min"),
        F.max("x").alias("max"),
    )
    quartiles = _pivoted(quantiles.exact_quantiles(rows, ["score"], QUARTILES, base), ["score"])
    base = base.select("score", F.col("n_filled").alias("n"), "mean", "std", "min", "max")
    return base.join(quartiles, "score")


def _pivoted(found: DataFrame, keys: Sequence[str]) -> DataFrame:
    picked = [
        F.max(F.when(F.col("prob") == prob, F.col("quantile"))).alias(f"q{round(prob * 100)}")
        for prob in QUARTILES
    ]
    return found.groupBy(*keys).agg(*picked)


def score_histogram(archive: DataFrame, bins: int = BINS) -> DataFrame:
    """Equal-width bins between minimum and maximum; the last bin is closed. Two scans.

    Empty bins are listed, and each row repeats the mean and median of its score.
    A score with a single value gets one unit-wide range around it.
    """
    rows, keys = long_scores(archive), ["score"]
    base = quantiles.sketched(
        rows, keys, F.min("x").alias("min"), F.max("x").alias("max"), F.avg("x").alias("mean")
    )
    flat = F.col("min") == F.col("max")
    ranges = base.withColumn("left", F.when(flat, F.col("min") - 0.5).otherwise(F.col("min")))
    ranges = ranges.withColumn("right", F.when(flat, F.col("max") + 0.5).otherwise(F.col("max")))
    ranges = ranges.withColumn("width", (F.col("right") - F.col("left")) / F.lit(bins))
    ranges = ranges.select("score", "left", "right", "width", "mean")

    def edge(i: Column) -> Column:
        return F.col("left") + i * F.col("width")

    # Division may land one bin off where a value sits on an edge.
    guess = F.least(
        F.floor((F.col("x") - F.col("left")) / (F.col("right") - F.col("left")) * bins),
        F.lit(bins - 1),
    )
    bin_ = (
        F.when(F.col("x") < edge(guess), guess - 1)
        .when((F.col("x") >= edge(guess + 1)) & (guess < bins - 1), guess + 1)
        .otherwise(guess)
    )
    positions = cut_lineage(quantiles.positions_of(base, keys, [0.5]))
    spans = quantiles.spans_of(positions, keys).join(ranges.drop("mean"), "score")
    counts = quantiles.counted(rows, keys, spans, bin_of=bin_)
    binned = counts.filter("span = 'bin'").select("score", F.col("side").alias("bin"), "n")
    median = quantiles.picked(rows, keys, positions, counts.filter("span <> 'bin'"))
    every = ranges.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    return (
        every.join(binned, ["score", "bin"], "left")
        .join(median.select("score", F.col("quantile").alias("median")), "score")
        .select(
            "score",
            "bin",
            edge(F.col("bin")).alias("bin_lo"),
            edge(F.col("bin") + 1).alias("bin_hi"),
            F.coalesce("n", F.lit(0)).alias("n"),
            "mean",
            "median",
        )
    )


def score_boxplot(archive: DataFrame) -> DataFrame:
    """Quartiles, 1.5 IQR whiskers and outlier count per decision and score; two scans.

    The spans that hold the quartiles also bound the fences, so values around a fence are
    counted with the quartiles, before the fence itself is known.
    """
    keys = ["decision_result", "score"]
    rows = long_scores(archive, keep=["decision_result"])
    positions = cut_lineage(quantiles.positions_of(quantiles.sketched(rows, keys), keys, QUARTILES))
    around = positions.groupBy(*keys).agg(
        *(
            F.max(F.when(F.col("prob") == prob, F.col(side))).alias(f"{side}_{name}")
            for prob, name in ((0.25, "q25"), (0.75, "q75"))
            for side in ("low", "high")
        )
    )
    least, most = (  # of the distance between the quartiles, one and a half times
        F.lit(1.5) * (F.col(a) - F.col(b)) for a, b in (("low_q75", "high_q25"), ("high_q75", "low_q25"))
    )
    least = F.greatest(least, F.lit(0.0))
    fences = around.select(
        *keys,
        F.inline(
            F.array(
                F.struct(F.lit("low").alias("span"), (F.col("low_q25") - most).alias("low"), (F.col("high_q25") - least).alias("high")),
                F.struct(F.lit("high").alias("span"), (F.col("low_q75") + least).alias("low"), (F.col("high_q75") + most).alias("high")),
            )
        ),
    )
    counts = quantiles.counted(
        rows, keys, quantiles.spans_of(positions, keys).unionByName(fences)
    )
    by_quartile = counts.filter(~F.col("span").isin("low", "high"))
    boxes = _pivoted(quantiles.picked(rows, keys, positions, by_quartile), keys)
    reach = (F.col("q75") - F.col("q25")) * F.lit(1.5)
    boxes = boxes.withColumn("low_fence", F.col("q25") - reach).withColumn(
        "high_fence", F.col("q75") + reach
    )
    around_fences = counts.filter(F.col("span").isin("low", "high"))
    held = boxes.join(fences.groupBy(*keys).agg(
        *(F.max(F.when(F.col("span") == span, F.col(side))).alias(f"{span}_{side}") for span in ("low", "high") for side in ("low", "high"))
    ), keys)
    astray = held.filter(
        ~(F.col("low_fence").between(F.col("low_low"), F.col("low_high")) & F.col("high_fence").between(F.col("high_low"), F.col("high_high")))
    )
    if not astray.isEmpty():
        # A sketch was off by more than its bound: count around the fences themselves.
        exact = boxes.select(*keys, F.inline(F.array(*(
            F.struct(F.lit(span).alias("span"), F.col(f"{span}_fence").alias("low"), F.col(f"{span}_fence").alias("high"))
            for span in ("low", "high")
        ))))
        around_fences = quantiles.counted(rows, keys, exact)
    # Rows of a side lie between its least and greatest value; those inside a span are by value.
    at_low = F.col("span") == "low"
    in_low = at_low & ((F.col("side") == quantiles.ABOVE) | (F.col("value") >= F.col("low_fence")))
    in_high = ~at_low & ((F.col("side") == quantiles.BELOW) | (F.col("value") <= F.col("high_fence")))
    spread = (
        around_fences.join(small_side(boxes), keys)
        .groupBy(*keys, "q25", "q50", "q75")
        .agg(
            F.min(F.when(in_low, F.col("least"))).alias("low"),
            F.max(F.when(in_high, F.col("greatest"))).alias("high"),
            F.coalesce(
                F.sum(F.when(~F.coalesce(in_low | in_high, F.lit(False)), F.col("n"))), F.lit(0)
            ).alias("outliers"),
        )
    )
    return spread.select(
        *keys,
        "q25",
        "q50",
        "q75",
        F.least("low", "q25").alias("whisker_low"),
        F.greatest("high", "q75").alias("whisker_high"),
        "outliers",
    )


def score_correlation(archive: DataFrame, scores: Sequence[str] = SCORES) -> DataFrame:
    """Pearson matrix in long form; all pairs come from one pass over the data."""
    pairs = [(a, b) for i, a in enumerate(scores) for b in scores[i + 1 :]]
    once = archive.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])

    def cell(a: str, b: str) -> Column:
        if a == b:
            value = F.lit(1.0)
        else:
            value = F.col(f"`{a}|{b}`" if (a, b) in pairs else f"`{b}|{a}`")
        return F.struct(F.lit(a).alias("score_a"), F.lit(b).alias("score_b"), value.alias("corr"))

    return once.select(F.inline(F.array(*[cell(a, b) for a in scores for b in scores])))


def corr_with_global(archive: DataFrame) -> DataFrame:
    return (
        score_correlation(archive)
        .filter(F.col("score_b") == "global_score")
        .select(F.col("score_a").alias("score"), "corr")
        .orderBy(F.desc("corr"))
    )


def scatter_pairs(archive: DataFrame) -> DataFrame:
    """Each component score against the global score, by decision."""
    kept = ["decision_id", "decision_result", "global_score"]
    return long_scores(archive, PARTS, kept)


def score_timeseries(archive: DataFrame) -> DataFrame:
    """Scores in time order."""
    return archive.select("decision_id", "decision_time", *SCORES).orderBy("decision_id")


def hourly_pattern(archive: DataFrame) -> DataFrame:
    """Average scores and show rate by hour of day."""
    return (
        archive.groupBy("hr")
        .agg(
            F.count("*").alias("decisions"),
            *[F.avg(score).alias(f"avg_{score}") for score in SCORES],
            _rate().alias("show_rate_pct"),
        )
        .orderBy("hr")
    )


def most_triggered_days(archive: DataFrame) -> DataFrame:
    """Days by how often the ad was shown."""
    return (
        archive.filter(_shown())
        .groupBy("dt")
        .agg(F.count("*").alias("shown"))
        .orderBy(F.desc("shown"), "dt")
    )


def dataset_overview(archive: DataFrame) -> DataFrame:
    """Shape, types and filled values per column."""
    filled = archive.agg(
        F.count("*").alias("n_rows"), *[F.count(F.col(c)).alias(f"n_{c}") for c in archive.columns]
    )
    described = [
        F.struct(
            F.lit(field.name).alias("column_name"),
            F.lit(field.dataType.simpleString()).alias("data_type"),
            F.col("n_rows"),
            F.col(f"n_{field.name}").alias("n_filled"),
        )
        for field in archive.schema.fields
    ]
    return filled.select(F.inline(F.array(*described)))


def top_scores(archive: DataFrame, n: int = 10) -> DataFrame:
    return (
        archive.select("decision_id", "global_score", "decision_result")
        .orderBy(F.desc("global_score"), "decision_id")
        .limit(n)
    )


def top_days(archive: DataFrame, n: int = 5) -> DataFrame:
    return (
        archive.groupBy("dt")
        .agg(
            F.avg("global_score").alias("avg_score"),
            F.max("global_score").alias("max_score"),
            F.count("*").alias("decisions"),
        )
        .orderBy(F.desc("avg_score"), "dt")
        .limit(n)
    )
