"""Exact, linearly interpolated quantiles in two scans, without gathering or sorting a group.

The first scan makes a mergeable sketch (KLL) of every group, beside whatever else is wanted of
it. A sketch bounds where a rank may lie: between two values a few thousandths of the rows
apart. The second scan counts, for all those spans at once, the rows below and above and the rows
of every value inside. What is left is the small table of values inside spans; ranks are found in
it by narrowing (``_order_statistics``): each pass cuts the open intervals into equal buckets,
counts rows per bucket (a partial aggregate, so a value that fills half of a group costs one row
per task) and keeps the bucket with the rank.

A sketch holds its bounds with high probability, not always. Ranks are compared with the
counted rows; one that lies outside its span is narrowed from the group's full range over the rows
themselves, so results are exact in any case.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citysignal.session import cut_lineage

BUCKETS = 2048
# Up to this many open intervals are sent to the rows; beyond it they are shuffled.
BROADCAST_SPANS = 200_000
# Size of a group's sketch, and the share of rows its ranks may be off by: three times the
# published error of that size.
SKETCH_K = 2048
SLACK = 3 * 2.446 / SKETCH_K**0.9433
FEW = 1000
BELOW, INSIDE, ABOVE = -1, 0, 1


def usable(rows: DataFrame) -> DataFrame:
    return rows.filter("x IS NOT NULL AND NOT isnan(x)")


def sketched(rows: DataFrame, keys: Sequence[str], *more: Column) -> DataFrame:
    """First scan: ``n``, ``lo``, ``hi``, ``sketch`` of column ``x`` per group, and ``more``."""
    x = F.when(~F.isnan("x"), F.col("x"))
    grouped = rows.groupBy(*keys).agg(
        F.count(x).alias("n"),
        F.min(x).alias("lo"),
        F.max(x).alias("hi"),
        F.kll_sketch_agg_double(x, F.lit(SKETCH_K)).alias("sketch"),
        *more,
    )
    return cut_lineage(grouped)


def bounds(prob: float) -> tuple[Column, Column]:
    """Values between which the quantile's two ranks lie, by the group's sketch."""

    def at(share: float, end: str) -> Column:
        sketch = F.kll_sketch_get_quantile_double("sketch", F.lit(min(max(share, 0.0), 1.0)))
        # In a small group a single rank is more than the slack.
        few = (F.col("n") < FEW) | F.lit(share <= 0 if end == "lo" else share >= 1)
        return F.when(few, F.col(end)).otherwise(sketch)

    return at(prob - SLACK, "lo"), at(prob + SLACK, "hi")


def positions_of(groups: DataFrame, keys: list[str], probs: Sequence[float]) -> DataFrame:
    """Where each quantile lies: ``prob``, ``at``, the ranks on both sides and the span that holds both."""
    each = []
    for prob in map(float, probs):
        low, high = bounds(prob)
        each.append(F.struct(F.lit(prob).alias("prob"), low.alias("low"), high.alias("high")))
    at = groups.filter("n > 0").select(*keys, "n", "lo", "hi", F.inline(F.array(*each)))
    return (
        at.withColumn("at", F.col("prob") * (F.col("n") - 1))
        .withColumn("rank_lo", F.floor("at"))
        .withColumn("rank_hi", F.ceil("at"))
        .drop("n")
    )


def counted(rows: DataFrame, keys: list[str], spans: DataFrame, *, bin_of: Column | None = None) -> DataFrame:
    """Second scan: rows by span and side, those inside by value: ``span``, ``side``, ``value``, ``n``,
    and the least and greatest value on that side.

    ``spans`` has keys, ``span``, ``low``, ``high``. ``bin_of`` adds counts by a group column's
    value as span ``bin``: a column of ``x`` and the columns that ``spans`` has besides.
    """
    extra = [name for name in spans.columns if name not in (*keys, "span", "low", "high")]
    whole = spans.groupBy(*keys, *extra).agg(
        F.collect_list(F.struct("span", "low", "high")).alias("spans")
    )
    if whole.limit(BROADCAST_SPANS + 1).count() <= BROADCAST_SPANS:
        whole = F.broadcast(whole)
    x = F.col("x")
    places = F.transform(
        "spans",
        lambda s: F.struct(
            s["span"].alias("span"),
            F.when(x < s["low"], BELOW).when(x > s["high"], ABOVE).otherwise(INSIDE).alias("side"),
            F.when((x >= s["low"]) & (x <= s["high"]), x).alias("value"),
        ),
    )
    if bin_of is not None:
        placed = F.struct(F.lit("bin").alias("span"), bin_of.cast("int").alias("side"), F.lit(None).cast("double").alias("value"))
        places = F.concat(F.array(placed), places)
    found = usable(rows).join(whole, keys).select(*keys, "x", F.inline(places))
    grouped = found.groupBy(*keys, "span", "side", "value").agg(
        F.count("*").alias("n"), F.min("x").alias("least"), F.max("x").alias("greatest")
    )
    return cut_lineage(grouped)


def _order_statistics(rows: DataFrame, keys: list[str], wanted: DataFrame) -> DataFrame:
    """Value at each zero-based rank; ``wanted`` has keys, ``rank``, ``lo``, ``hi``, ``skip``.

    ``rows`` has ``x`` and the number of times ``w`` that it counts; ``skip`` is the number of rows of the
    group that lie below the interval.
    """
    done = wanted.filter("lo = hi")
    open_ = wanted.filter("lo < hi")
    while True:
        spans = open_.select(*keys, "lo", "hi").distinct()
        n_spans = spans.count()
        if n_spans == 0:
            break
        if n_spans <= BROADCAST_SPANS:
            spans = F.broadcast(spans)
        share = (F.col("x") - F.col("lo")) / (F.col("hi") - F.col("lo"))
        bucket = F.least(F.floor(share * BUCKETS), F.lit(BUCKETS - 1))
        counts = (
            rows.join(spans, keys)
            .filter("x >= lo AND x <= hi")
            .groupBy(*keys, "lo", "hi", bucket.alias("bucket"))
            .agg(F.sum("w").alias("n"), F.min("x").alias("b_lo"), F.max("x").alias("b_hi"))
        )
        # At most BUCKETS rows per interval.
        below = Window.partitionBy(*keys, "lo", "hi").orderBy("bucket")
        placed = counts.withColumn("upto", F.sum("n").over(below))
        offset = F.col("rank") - F.col("skip")
        step = (
            open_.join(placed, [*keys, "lo", "hi"])
            .filter((offset < F.col("upto")) & (offset >= F.col("upto") - F.col("n")))
            .select(
                *keys,
                "rank",
                F.col("b_lo").alias("lo"),
                F.col("b_hi").alias("hi"),
                (F.col("skip") + F.col("upto") - F.col("n")).alias("skip"),
            )
        )
        step = cut_lineage(step)
        done = done.unionByName(step.filter("lo = hi"))
        open_ = step.filter("lo < hi")
    return done.select(*keys, "rank", F.col("lo").alias("value"))


def picked(rows: DataFrame, keys: list[str], positions: DataFrame, counts: DataFrame) -> DataFrame:
    """``(keys..., prob, quantile)`` from the counts of the spans named after each ``prob``."""
    positions = positions.withColumn("span", F.col("prob").cast("string"))
    sides = counts.groupBy(*keys, "span").agg(
        F.coalesce(F.sum(F.when(F.col("side") == BELOW, F.col("n"))), F.lit(0)).alias("skip"),
        F.coalesce(F.sum(F.when(F.col("side") == INSIDE, F.col("n"))), F.lit(0)).alias("held"),
        F.min(F.when(F.col("side") == INSIDE, F.col("least"))).alias("first"),
        F.max(F.when(F.col("side") == INSIDE, F.col("greatest"))).alias("last"),
    )
    wanted = cut_lineage(
        positions.join(sides, [*keys, "span"], "left")
        .withColumn("rank", F.explode(F.array("rank_lo", "rank_hi")))
        .withColumn("inside", F.coalesce((F.col("rank") >= F.col("skip")) & (F.col("rank") < F.col("skip") + F.col("held")), F.lit(False)))
    )
    by_span = [*keys, "span"]
    reduced = counts.filter(F.col("side") == INSIDE).select(*by_span, F.col("value").alias("x"), F.col("n").alias("w"))
    narrow = wanted.filter("inside").select(
        *by_span, "rank", F.col("first").alias("lo"), F.col("last").alias("hi"), F.col("skip").cast("bigint")
    )
    values = _order_statistics(reduced, by_span, narrow.distinct()).drop("span")
    astray = wanted.filter("NOT inside")
    if not astray.isEmpty():
        whole = usable(rows).select(*keys, "x", F.lit(1).cast("bigint").alias("w"))
        full = astray.select(*keys, "rank", "lo", "hi", F.lit(0).cast("bigint").alias("skip"))
        values = values.unionByName(_order_statistics(whole, keys, full.distinct()))
    values = values.distinct()

    def at(rank: str) -> DataFrame:
        return values.withColumnRenamed("rank", rank).withColumnRenamed("value", f"{rank}_value")

    low, high = F.col("rank_lo_value"), F.col("rank_hi_value")
    return (
        positions.select(*keys, "prob", "at", "rank_lo", "rank_hi")
        .join(at("rank_lo"), [*keys, "rank_lo"])
        .join(at("rank_hi"), [*keys, "rank_hi"])
        .select(
            *keys,
            "prob",
            (low + (high - low) * (F.col("at") - F.col("rank_lo"))).alias("quantile"),
        )
    )


def spans_of(positions: DataFrame, keys: list[str]) -> DataFrame:
    return positions.select(*keys, F.col("prob").cast("string").alias("span"), "low", "high")


def exact_quantiles(
    rows: DataFrame,
    keys: Sequence[str],
    probs: Sequence[float],
    groups: DataFrame | None = None,
) -> DataFrame:
    """``(keys..., prob, quantile)`` of column ``x`` per group.

    Interpolates linearly between neighbouring ranks. Null and NaN are ignored. ``groups`` is
    what ``sketched`` made of the same rows, if it is there already.
    """
    keys = list(keys)
    rows = rows.select(*keys, "x")
    groups = sketched(rows, keys) if groups is None else groups
    positions = cut_lineage(positions_of(groups, keys, probs))
    counts = counted(rows, keys, spans_of(positions, keys))
    return picked(rows, keys, positions, counts)
