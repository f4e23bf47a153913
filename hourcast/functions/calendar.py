"""Calendar, cyclical and time-arithmetic expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourcast.schema import LOCAL_TZ, TS


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def to_ntz(x) -> Column:
    return _c(x).cast("timestamp_ntz")


def floor_hour(x) -> Column:
    """``date_trunc('hour')`` kept as TIMESTAMP_NTZ (date_trunc widens NTZ)."""
    return F.date_trunc("hour", _c(x)).cast("timestamp_ntz")


def epoch_micros(x) -> Column:
    return F.unix_micros(_c(x).cast("timestamp"))


def hours_between(later, earlier) -> Column:
    return (epoch_micros(later) - epoch_micros(earlier)) / F.lit(3.6e9)


def add_hours(x, hours) -> Column:
    return _c(x) + F.make_dt_interval(F.lit(0), F.lit(hours) if not isinstance(hours, Column) else hours)


def day_of_week(x) -> Column:
    """Monday = 0 ... Sunday = 6."""
    return F.weekday(_c(x))


def local_time(x, tz: str = LOCAL_TZ) -> Column:
    """UTC instant -> wall clock of ``tz`` (TIMESTAMP_NTZ)."""
    return F.from_utc_timestamp(_c(x).cast("timestamp"), tz).cast("timestamp_ntz")


def cyclical(x, period: int, fn: str) -> Column:
    angle = F.lit(2 * math.pi) * _c(x) / F.lit(float(period))
    return F.sin(angle) if fn == "sin" else F.cos(angle)


def add_calendar(df: DataFrame, ts: str = TS, only_missing: bool = False) -> DataFrame:
    cols = {
        "hour_of_day": F.hour(ts).cast("long"),
        "day_of_week": day_of_week(ts).cast("long"),
        "month": F.month(ts).cast("long"),
    }
    if only_missing:
        cols = {k: v for k, v in cols.items() if k not in df.columns}
    return df.withColumns(cols) if cols else df


def add_cyclical(df: DataFrame, only_missing: bool = False) -> DataFrame:
    cols = {
        "hour_sin": cyclical("hour_of_day", 24, "sin"),
        "hour_cos": cyclical("hour_of_day", 24, "cos"),
        "dow_sin": cyclical("day_of_week", 7, "sin"),
        "dow_cos": cyclical("day_of_week", 7, "cos"),
    }
    if only_missing:
        cols = {k: v for k, v in cols.items() if k not in df.columns}
    return df.withColumns(cols) if cols else df
