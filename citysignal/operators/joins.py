"""Join sides that are broadcast only after their size was checked."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows of a narrow table that every executor can hold without strain.
SMALL_ROWS = 200_000


def small_side(df: DataFrame, limit: int = SMALL_ROWS) -> DataFrame:
    """Broadcast ``df`` if it has at most ``limit`` rows.

    A larger one is left to a shuffle join, in which the adaptive planner splits
    keys that are too frequent. Counting stops once the limit is passed; use this
    on sides that are stored or cheap to compute.
    """
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df
