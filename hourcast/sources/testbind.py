"""Binding of the driver's ``events`` table to the hourly series model.

``series = event_type``, ``timestamp = hour of ts``; every measure is an
aggregate of the events of that hour (partial aggregation, so a hot series
is combined map-side before the shuffle)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourcast.functions.aqi import pm25_to_aqi
from hourcast.functions.calendar import floor_hour
from hourcast.schema import SERIES, TS
from hourcast.sources.tables import table

# A forecast row is stamped this long after the hour whose events it is made of, so the
# forecast table holds the whole grid, reaches beyond the readings, and leaves the first
# readings without a forecast.
FORECAST_LEAD_DAYS = 10


def _events(spark: SparkSession, sf_dir: str, since: str | None = None, until: str | None = None,
            lead_days: int = 0) -> DataFrame:
    """Events of the hours in [since, until), each ``lead_days`` earlier. The predicates are on the raw
    column so the Parquet scan prunes row groups; bounds lie on hours, so they select whole hours."""
    ev = table(spark, sf_dir, "events")
    lead = F.make_dt_interval(F.lit(lead_days))
    if since is not None:
        ev = ev.filter(F.col("ts") >= F.lit(since).cast("timestamp_ntz") - lead)
    if until is not None:
        ev = ev.filter(F.col("ts") < F.lit(until).cast("timestamp_ntz") - lead)
    return ev.select(
        F.col("event_type").alias(SERIES),
        floor_hour("ts").alias(TS),
        "value", "user_id",
        F.get_json_object("props", "$.k").try_cast("double").alias("_k"),
    )


def _air_aggs():
    return [
        F.avg("value").alias("pm25"),
        F.max("value").alias("pm10"),
        F.avg("_k").alias("o3"),
        F.stddev_samp("value").alias("no2"),
        F.sum("value").alias("so2"),
        F.min("value").alias("co"),
    ]


def _weather_aggs():
    return [
        F.avg("user_id").alias("temperature"),
        F.max("user_id").cast("double").alias("humidity"),
        F.count(F.lit(1)).cast("double").alias("wind_speed"),
    ]


def air_hourly(spark: SparkSession, sf_dir: str, since: str | None = None, until: str | None = None) -> DataFrame:
    return _events(spark, sf_dir, since, until).groupBy(SERIES, TS).agg(*_air_aggs())


def weather_hourly(spark: SparkSession, sf_dir: str, since: str | None = None, until: str | None = None) -> DataFrame:
    return _events(spark, sf_dir, since, until).groupBy(SERIES, TS).agg(*_weather_aggs())


def obs_hourly(spark: SparkSession, sf_dir: str, since: str | None = None, until: str | None = None) -> DataFrame:
    """Raw reading table: series, timestamp, aqi, pm25 ... wind_speed (one pass);
    ``since`` and ``until`` (hour boundaries, the second exclusive) restrict the scan."""
    agg = _events(spark, sf_dir, since, until).groupBy(SERIES, TS).agg(*_air_aggs(), *_weather_aggs())
    return agg.select(SERIES, TS, pm25_to_aqi("pm25").alias("aqi"), "pm25", "pm10", "o3", "no2", "so2", "co",
                      "temperature", "humidity", "wind_speed")


def all_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as one gap-free series named ``all``."""
    ev = _events(spark, sf_dir).withColumn(SERIES, F.lit("all"))
    agg = ev.groupBy(SERIES, TS).agg(*_air_aggs(), *_weather_aggs())
    return agg.select(SERIES, TS, pm25_to_aqi("pm25").alias("aqi"), "pm25", "pm10", "o3", "no2", "so2", "co",
                      "temperature", "humidity", "wind_speed")


def forecast_hourly(spark: SparkSession, sf_dir: str, since: str | None = None, until: str | None = None,
                    lead_days: int = FORECAST_LEAD_DAYS) -> DataFrame:
    """Forecast table: the measures of the whole hourly grid as fc_*, stamped ``lead_days``
    later; ``since`` and ``until`` restrict the stamps at the scan."""
    ev = _events(spark, sf_dir, since, until, lead_days).withColumn(TS, F.col(TS) + F.make_dt_interval(F.lit(lead_days)))
    return ev.groupBy(SERIES, TS).agg(
        F.avg("value").alias("fc_pm25"),
        F.min("value").alias("fc_co"),
        F.stddev_samp("value").alias("fc_no2"),
        F.sum("value").alias("fc_so2"),
        F.avg("_k").alias("fc_o3"),
        F.avg("user_id").alias("fc_dust"),
        F.count(F.lit(1)).cast("double").alias("fc_uvi"),
    )
