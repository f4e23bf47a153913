"""Bulk history -> feature rows (pollutants join weather, AQI, engineered
features, forecast windows, shifted back-fill) as one lazy plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourcast.functions.aqi import pm25_to_aqi
from hourcast.functions.numeric import coerce_double
from hourcast.operators.halo import RN, with_positions
from hourcast.operators.joins import forecast_windows, join_on_time
from hourcast.operators.windows import add_engineered_features, shifted_backfill
from hourcast.schema import FORECAST_WINDOW_COLUMNS, SERIES, TS, ensure_columns

MEASURES = ["pm25", "pm10", "o3", "no2", "so2", "co", "temperature", "humidity", "wind_speed"]


def build_backfill_dataset(air: DataFrame, weather: DataFrame, forecast: DataFrame | None = None,
                           strategy: str | None = None) -> DataFrame:
    data = join_on_time(air, weather, "inner")
    data = data.withColumns({c: coerce_double(c) for c in MEASURES if c in data.columns})
    data = data.withColumn("aqi", pm25_to_aqi("pm25"))
    data = with_positions(data, SERIES, TS, strategy)
    data = add_engineered_features(data, SERIES, TS, strategy=strategy)
    if forecast is not None:
        data = forecast_windows(data.drop(*[c for c in FORECAST_WINDOW_COLUMNS if c in data.columns]), forecast)
    data = ensure_columns(data, FORECAST_WINDOW_COLUMNS)
    return shifted_backfill(data, SERIES, TS, strategy=strategy).drop(RN)
