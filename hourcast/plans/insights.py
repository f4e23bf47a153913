"""One summary row per series (the EDA insight block), built from one-row
per-series aggregates joined on the series key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourcast.operators import aggregates as AG
from hourcast.schema import SERIES, TS


def insight_rows(df: DataFrame, value: str = "aqi", series=SERIES, ts=TS) -> DataFrame:
    base = df.groupBy(series).agg(
        F.count(F.lit(1)).alias("n"),
        F.date_format(F.min(ts), "MMM dd, yyyy").alias("date_min"),
        F.date_format(F.max(ts), "MMM dd, yyyy").alias("date_max"),
        F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"),
        F.corr(value, "pm25").alias("pm25_corr"))
    shares = AG.shares(df, value, series)
    hours = AG.arg_extremes(AG.profile(df, "local_hour", value, series), "local_hour") \
        .select(series, F.col("peak").alias("peak_hour"), F.col("clean").alias("clean_hour"))
    d = AG.gap_steps(df, series, ts)
    gaps = d.groupBy(series).agg(F.count_if(F.col("gap_hours") != 1.0).alias("total_gaps"))
    # series with a single row have no steps
    gaps = df.select(series).distinct().join(gaps, series, "left") \
        .select(series, F.coalesce("total_gaps", F.lit(0)).alias("total_gaps"))
    return base.join(shares, series).join(hours, series).join(gaps, series)
