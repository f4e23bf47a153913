"""Feature-table sinks: idempotent keyed append (anti-join on the key, then
append into month partitions). Re-running the same input writes nothing new,
so task/job retries and stream replays are safe without MERGE support."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourcast.operators.joins import anti_join_new
from hourcast.operators.ordering import pick_per_group
from hourcast.schema import APPEND_DROP_COLUMNS, SERIES, TS

PARTITION_COLUMN = "ym"
DELIVERY_COLUMN = "delivery"  # who wrote the rows: a bulk load or a micro-batch


def table_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(conf)
    return fs.exists(jvm.org.apache.hadoop.fs.Path(path + "/_SUCCESS")) or (
        fs.exists(p) and len([s for s in fs.listStatus(p) if s.getPath().getName().startswith(PARTITION_COLUMN + "=")]) > 0)


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    if not table_exists(spark, path):
        return None
    return spark.read.parquet(path)


def prepare_for_store(df: DataFrame, drop=APPEND_DROP_COLUMNS, ts=TS) -> DataFrame:
    out = df.drop(*drop)
    casts = {c: F.col(c).cast("long") for c in ("hour_of_day", "day_of_week", "month") if c in out.columns}
    out = out.withColumns(casts) if casts else out
    return out.withColumn(PARTITION_COLUMN, F.date_format(ts, "yyyy-MM"))


def stored_between(stored: DataFrame, lo, hi) -> DataFrame:
    """Stored rows with ``lo <= timestamp <= hi``: whole months are pruned by partition."""
    month = F.col(PARTITION_COLUMN)
    return stored.filter((month >= F.lit(f"{lo:%Y-%m}")) & (month <= F.lit(f"{hi:%Y-%m}"))
                         & (F.col(TS) >= F.lit(lo)) & (F.col(TS) <= F.lit(hi)))


def append_new(spark: SparkSession, rows: DataFrame, path: str, keys=(SERIES, TS), drop=APPEND_DROP_COLUMNS) -> int:
    """Append rows whose key is not stored yet; returns the number appended."""
    existing = read_table(spark, path)
    # one row per key inside the batch (deterministic pick), then drop stored keys
    rest = [c for c in rows.columns if c not in keys]
    once = pick_per_group(rows, list(keys), [F.col(c) for c in rest]) if rest else rows.distinct()
    if existing is not None:
        # Only the months and the stamps that the batch covers can hold its keys.
        span = once.agg(F.min(TS).alias("lo"), F.max(TS).alias("hi")).first()
        if span.lo is None:
            return 0
        existing = stored_between(existing, span.lo, span.hi)
    new = anti_join_new(once, existing, list(keys)) if existing is not None else once
    new = prepare_for_store(new, drop).cache()
    n = new.count()
    if n:
        write_delivery(new, path, f"load-{uuid.uuid4().hex[:12]}")
    new.unpersist()
    return n


def write_delivery(rows: DataFrame, path: str, delivery: str) -> None:
    """Write prepared rows as one delivery; writing it again replaces it."""
    rows.withColumn(DELIVERY_COLUMN, F.lit(delivery)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        PARTITION_COLUMN, DELIVERY_COLUMN).parquet(path)


def stored_rows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(PARTITION_COLUMN, DELIVERY_COLUMN)
