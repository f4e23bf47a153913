"""Scoring-side data steps: alerts, trend frame, prediction assembly."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourcast.schema import LOCAL_TZ, SERIES

ALERT_THRESHOLD = 150.0


def alerts(preds: DataFrame, series=SERIES, threshold: float = ALERT_THRESHOLD) -> DataFrame:
    """Per series: any horizon above ``threshold`` and the list of such horizons
    ('24h, 72h', ascending). Input: series, horizon (int), prediction."""
    over = F.col("prediction") > threshold
    hs = F.array_sort(F.collect_list(F.when(over, F.col("horizon"))))
    return preds.groupBy(series).agg(
        F.max(over).alias("alert"),
        F.array_join(F.transform(hs, lambda h: F.concat(h.cast("string"), F.lit("h"))), ", ").alias("horizons"),
        F.max("prediction").alias("max_prediction"),
    )


def trend_frame(history: DataFrame, preds: DataFrame, last_n: int = 72, series=SERIES, ts="timestamp",
                tz: str = LOCAL_TZ) -> DataFrame:
    """Newest ``last_n`` actual rows (display AQI from pm25, or ``aqi`` where there is no pm25) plus one forecast
    point per horizon at ``timestamp + horizon`` hours, with local wall time."""
    from hourcast.functions.aqi import pm25_to_aqi
    from hourcast.functions.calendar import local_time
    from hourcast.operators.ordering import latest_n
    act = latest_n(history, last_n, series, ts).select(
        series, ts, F.lit("actual").alias("kind"), F.lit(None).cast("int").alias("horizon"),
        (pm25_to_aqi("pm25") if "pm25" in history.columns else F.col("aqi")).alias("value"))
    fut = preds.select(series, (F.col(ts) + F.make_dt_interval(F.lit(0), F.col("horizon"))).alias(ts),
                       F.lit("forecast").alias("kind"), F.col("horizon").cast("int").alias("horizon"),
                       F.col("prediction").alias("value"))
    out = act.unionByName(fut)
    return out.withColumn("local_ts", local_time(ts, tz))
