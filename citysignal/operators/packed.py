"""Two whole numbers as one that sorts like the pair.

A plain number keeps ``min_by`` and ``max_by`` in the hash aggregate, where a struct
would need a sort. ``DECIMAL(38,0)`` holds a full BIGINT in the lower part and up to
18 digits in the upper one.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1
PACKED = "decimal(38,0)"


def _whole(value: int) -> Column:
    return F.lit(str(value)).cast("decimal(20,0)")


def raised(high: Column) -> Column:
    """The upper part alone, to be added to a packed number."""
    return (high.cast("decimal(20,0)") * _whole(1 << 64)).cast(PACKED)


def pack(high: Column, low: Column) -> Column:
    """One number for ``(high, low)``; a null ``low`` sorts with the lowest BIGINT."""
    lower = F.coalesce(low.cast("bigint"), F.lit(LOWEST)).cast("decimal(20,0)")
    return (raised(high) + (lower - _whole(LOWEST))).cast(PACKED)


def pack_descending(high: Column, low: Column) -> Column:
    """Like ``pack``, with the order of the lower part turned round."""
    lower = F.coalesce(low.cast("bigint"), F.lit(LOWEST)).cast("decimal(20,0)")
    return (raised(high) + (_whole(HIGHEST) - lower)).cast(PACKED)


def high_of(packed: Column) -> Column:
    """The upper part of a packed number, for upper parts of zero or more."""
    return F.call_function("div", packed, _whole(1 << 64))
