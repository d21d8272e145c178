"""Time-ordered row keys: building, parsing and cutting them into partitions.

Keys start with the wall-clock time, so chronological order is string order and
a time range is a half-open key range. The session time zone is UTC (see
``session.configure``); ``tz`` renders the wall clock of another zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECOND_KEY = "yyyyMMdd_HHmmss"
HOUR_KEY = "yyyyMMdd_HH"
DAY_KEY = "yyyyMMdd"
FORECAST_TIME = "yyyy-MM-dd'T'HH:mm"
CLOCK_TIME = "yyyy-MM-dd HH:mm:ss"


def wall_clock(ts: Column, tz: str = "UTC") -> Column:
    return ts if tz == "UTC" else F.from_utc_timestamp(ts, tz)


def second_key(ts: Column, tz: str = "UTC") -> Column:
    return F.date_format(wall_clock(ts, tz), SECOND_KEY)


def hour_key(ts: Column, tz: str = "UTC") -> Column:
    return F.date_format(wall_clock(ts, tz), HOUR_KEY)


def hour_start(key: Column, tz: str = "UTC") -> Column:
    """When the hour of an hour key begins, null when the key is not one."""
    local = F.try_to_timestamp(key, F.lit(HOUR_KEY))
    return local if tz == "UTC" else F.to_utc_timestamp(local, tz)


def vehicle_key(ts: Column, vehicle: Column, tz: str = "UTC") -> Column:
    """Second key plus vehicle number; the bare second key when that is null."""
    return F.concat_ws("_", second_key(ts, tz), vehicle)


def key_vehicle(key: Column) -> Column:
    """The vehicle number in a vehicle key, null in a bare second key."""
    return F.get(F.split(key, "_", 3), F.lit(2))


def tweet_key(ts: Column, tweet_id: Column, tz: str = "UTC") -> Column:
    """Second key plus message id; null when either is null."""
    return F.concat(second_key(ts, tz), F.lit("_"), tweet_id)


def forecast_hour(time: Column) -> Column:
    """Timestamp of an ISO minute string, null when it cannot be read."""
    return F.try_to_timestamp(time, F.lit(FORECAST_TIME))


def forecast_key(time: Column) -> Column:
    return F.date_format(forecast_hour(time), HOUR_KEY)


def key_timestamp(key: Column) -> Column:
    """Timestamp of the first two key parts, null when they are not a time."""
    parts = F.split(key, "_")
    stamp = F.concat(F.get(parts, F.lit(0)), F.get(parts, F.lit(1)))
    return F.try_to_timestamp(stamp, F.lit("yyyyMMddHHmmss"))


def key_date(key: Column) -> Column:
    return F.substring_index(key, "_", 1)


def key_hour_of_day(key: Column) -> Column:
    return F.substring(F.get(F.split(key, "_"), F.lit(1)), 1, 2)


def recent_bounds(as_of: str | Column, back: str) -> tuple[Column, Column]:
    """``[start, stop)`` keys of the period of length ``back`` before ``as_of``."""
    end = F.lit(as_of).cast("timestamp") if isinstance(as_of, str) else as_of
    return second_key(end - F.expr(f"INTERVAL {back}")), second_key(end)
