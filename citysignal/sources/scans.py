"""Reads by key: ranges, single rows, ordered heads and recent periods.

Tables partitioned by ``dt`` (and ``hr``) get the matching partition predicates
added, because a range over the key column alone cannot prune folders.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citysignal import config as C
from citysignal import schemas
from citysignal.functions import keys


def partition_range(df: DataFrame, start: str | Column, stop: str | Column) -> Column:
    """Predicate on ``dt`` and ``hr`` implied by a half-open key range.

    Bounds are cut to ``dt_hr`` strings, which order like the keys themselves.
    """
    start = F.lit(start) if isinstance(start, str) else start
    stop = F.lit(stop) if isinstance(stop, str) else stop
    test = F.lit(True)
    if "dt" in df.columns:
        test = (F.col("dt") >= F.substring(start, 1, 8)) & (F.col("dt") <= F.substring(stop, 1, 8))
        if "hr" in df.columns:
            slot = F.concat_ws("_", "dt", "hr")
            test = (
                test
                & (slot >= F.substring(start, 1, 11))
                & (slot <= F.substring(stop, 1, 11))
            )
    return test


def scan_range(
    df: DataFrame, start: str | Column, stop: str | Column, key: str = "row_key"
) -> DataFrame:
    """Rows with ``start <= key < stop``."""
    return df.filter(
        partition_range(df, start, stop) & (F.col(key) >= start) & (F.col(key) < stop)
    )


def get_row(df: DataFrame, value: str, key: str = "row_key") -> DataFrame:
    """The row of one key, pruned to its partition when the table has any."""
    test = F.col(key) == value
    if "dt" in df.columns:
        test = test & (F.col("dt") == value[:8])
        if "hr" in df.columns:
            test = test & (F.col("hr") == value[9:11])
    return df.filter(test)


def scan_limit(df: DataFrame, n: int, key: str = "row_key") -> DataFrame:
    """The first ``n`` rows in key order."""
    return df.orderBy(key).limit(n)


def with_defaults(rows: DataFrame, campaign: bool = False) -> DataFrame:
    """Typed decision rows from a store of strings, gaps filled with the neutral value.

    ``campaign`` adds ``campaign_type``, empty where the rows have none.
    """
    extra = []
    if campaign:
        known = F.col("campaign_type") if "campaign_type" in rows.columns else F.lit("")
        extra = [F.coalesce(known.cast("string"), F.lit("")).alias("campaign_type")]

    def score(name: str) -> Column:
        return F.coalesce(F.col(name).try_cast("double"), F.lit(0.0)).alias(name)

    def text(name: str, default: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(default)).alias(name)

    return rows.select(
        "decision_id",
        *[score(name) for name in schemas.SCORES],
        text("decision_result", C.NO_AD),
        text("target_locations", "[]"),
        text("decision_time", ""),
        text("display_time", ""),
        *extra,
    )


def load_recent(df: DataFrame, as_of: str | Column, back: str = "24 hours") -> DataFrame:
    """Decisions of the period before ``as_of``, typed and with defaults."""
    start, stop = keys.recent_bounds(as_of, back)
    return with_defaults(scan_range(df, start, stop, key="decision_id"))
