"""Filters, sorts, limits, top-k, deterministic samples, dedupe and
per-series selections. Per-series picks are written as aggregates
(``max_by``) so they combine map-side and a hot series is never one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourcast.schema import SERIES, TS


def pick_per_group(df: DataFrame, keys, order: list[Column]) -> DataFrame:
    """One row per ``keys``: the row with the largest ``order`` tuple."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    rest = [c for c in df.columns if c not in keys]
    packed = F.struct(*[F.col(c) for c in rest])
    got = df.groupBy(*keys).agg(F.max_by(packed, F.struct(*order)).alias("_row"))
    return got.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])


def dedupe_latest(df: DataFrame, keys, order: list[Column]) -> DataFrame:
    """Deterministic one-row-per-key (``dropDuplicates`` keeps an arbitrary row)."""
    return pick_per_group(df, keys, order)


def current_or_last(df: DataFrame, as_of, series=SERIES, ts=TS) -> DataFrame:
    """Per series: the row stamped at the ``as_of`` hour, else the newest row."""
    hour = F.date_trunc("hour", F.lit(as_of).cast("timestamp")).cast(df.schema[ts].dataType)
    return pick_per_group(df, series, [(F.col(ts) == hour), F.col(ts)])


def carry_forward(history: DataFrame, series_list: DataFrame, as_of, series=SERIES, ts=TS) -> DataFrame:
    """Newest row of each series re-stamped to the ``as_of`` hour; a series with
    no history yields one all-NULL row."""
    hour = F.date_trunc("hour", F.lit(as_of).cast("timestamp")).cast(history.schema[ts].dataType)
    newest = pick_per_group(history, series, [F.col(ts)])
    out = series_list.select(series).distinct().join(newest, series, "left")
    return out.withColumn(ts, hour).select(*history.columns)


def latest_n(df: DataFrame, n: int, series=SERIES, ts=TS) -> DataFrame:
    """Newest ``n`` rows per series (WindowGroupLimit keeps ``n`` per task)."""
    w = Window.partitionBy(series).orderBy(F.col(ts).desc())
    return df.withColumn("_rk", F.row_number().over(w)).filter(F.col("_rk") <= n).drop("_rk")


def latest_n_then_filter(df: DataFrame, n: int, cond: Column, series=SERIES, ts=TS) -> DataFrame:
    """LIMIT before filter: fewer than ``n`` rows may survive."""
    return latest_n(df, n, series, ts).filter(cond)


def clamp_time(ts, as_of) -> Column:
    return F.least(F.col(ts) if isinstance(ts, str) else ts, F.lit(as_of).cast("timestamp_ntz"))


def minstd_hash(key, seed: int = 42) -> Column:
    """Seeded multiplicative (Lehmer) hash of an integer key: reproducible across
    partitionings and engines, no overflow for 64-bit keys."""
    k = F.col(key) if isinstance(key, str) else key
    return F.pmod(F.pmod(k, F.lit(2147483647)) * F.lit(48271) + F.lit(seed), F.lit(2147483647))


def deterministic_sample(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """Up to ``n`` rows chosen by seeded hash order (TakeOrderedAndProject)."""
    return df.orderBy(minstd_hash(key, seed), F.col(key)).limit(n)


def top_k(df: DataFrame, k: int, by: Column, tiebreak) -> DataFrame:
    return df.orderBy(by.desc(), *[F.col(t) for t in tiebreak]).limit(k)
