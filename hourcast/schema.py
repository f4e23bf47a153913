"""Column sets and schema helpers shared by all operators.

The lists below are fixed values: they must equal the feature contract of the
system being re-implemented for trained models and stored tables to line up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SERIES = "series"
TS = "timestamp"

# ---- fixed values (feature contract) -------------------------------------
LAG_HOURS = [1, 3, 6, 12, 24]
ROLLING_WINDOWS = [6, 24]
TARGET_HORIZONS = [24, 48, 72]
FORECAST_WINDOWS = [("24h", 0, 24), ("48h", 24, 48), ("72h", 48, 72)]
FORECAST_COLUMNS = ["fc_pm25", "fc_co", "fc_no2", "fc_so2", "fc_o3", "fc_dust", "fc_uvi"]
FORECAST_BASE_FEATURES = ["fc_co", "fc_no2", "fc_so2", "fc_o3", "fc_dust", "fc_uvi"]
RAW_COLUMNS = ["timestamp", "aqi", "pm25", "pm10", "o3", "no2", "so2", "co",
               "temperature", "humidity", "wind_speed"]
POLLUTANTS = ["aqi", "pm25", "pm10", "o3", "no2", "so2", "co",
              "temperature", "humidity", "wind_speed"]
FEATURE_COLUMNS = [
    "aqi", "pm25", "pm10", "o3", "no2", "so2", "co",
    "temperature", "humidity", "wind_speed",
    "hour_of_day", "day_of_week", "month",
    "hour_sin", "hour_cos", "dow_sin", "dow_cos",
    "hours_since_prev", "is_gap",
    "aqi_lag_1h", "aqi_lag_3h", "aqi_lag_6h", "aqi_lag_12h", "aqi_lag_24h",
    "rolling_mean_6h", "rolling_mean_24h", "rolling_std_6h", "rolling_std_24h",
]
BASE_FEATURE_COLS = FEATURE_COLUMNS[:17]
HORIZON_LAG_COLS = {
    24: ["aqi_lag_1h", "aqi_lag_3h", "aqi_lag_6h", "aqi_lag_12h", "aqi_lag_24h"],
    48: ["aqi_lag_6h", "aqi_lag_12h", "aqi_lag_24h"],
    72: ["aqi_lag_12h", "aqi_lag_24h"],
}
HORIZON_ROLLING_COLS = {
    24: ["rolling_mean_6h", "rolling_mean_24h", "rolling_std_6h", "rolling_std_24h"],
    48: ["rolling_mean_24h", "rolling_std_24h"],
    72: ["rolling_mean_24h", "rolling_std_24h"],
}
HORIZON_FORECAST_WINDOWS = {24: ["24h"], 48: ["48h"], 72: ["72h"]}
COVERAGE_THRESHOLD = 0.05
# columns the hourly append drops before storing (leakage / transient)
APPEND_DROP_COLUMNS = ["hours_since_prev", "is_gap", "fc_pm25_24h", "fc_pm25_48h", "fc_pm25_72h"]
# back-fill sources for missing forecast windows: forecast column -> observed column
SHIFT_BACKFILL_SOURCES = [("fc_pm25", "pm25"), ("fc_co", "co"), ("fc_no2", "no2"),
                          ("fc_so2", "so2"), ("fc_o3", "o3")]
ZERO_BACKFILL_COLUMNS = ["fc_dust", "fc_uvi"]
MODEL_PREFERRED_ORDER = ["random_forest", "ridge", "xgboost", "lstm"]
LOOKBACK_WINDOW = 24
LOCAL_TZ = "Asia/Karachi"
# ---------------------------------------------------------------------------

LAG_COLUMNS = [f"aqi_lag_{h}h" for h in LAG_HOURS]
ROLLING_COLUMNS = ([f"rolling_mean_{n}h" for n in ROLLING_WINDOWS]
                   + [f"rolling_std_{n}h" for n in ROLLING_WINDOWS])
FORECAST_WINDOW_COLUMNS = [f"{c}_{label}" for label, _, _ in FORECAST_WINDOWS for c in FORECAST_COLUMNS]
FORECAST_FEATURE_COLS = [f"{b}_{label}" for label, _, _ in FORECAST_WINDOWS for b in FORECAST_BASE_FEATURES]

MEASURE_SCHEMA = T.StructType(
    [T.StructField(SERIES, T.StringType(), False), T.StructField(TS, T.TimestampNTZType(), False)]
    + [T.StructField(c, T.DoubleType(), True) for c in RAW_COLUMNS[1:]]
)
FORECAST_SCHEMA = T.StructType(
    [T.StructField(SERIES, T.StringType(), False), T.StructField(TS, T.TimestampNTZType(), False)]
    + [T.StructField(c, T.DoubleType(), True) for c in FORECAST_COLUMNS]
)
METRICS_STRUCT = T.StructType([T.StructField(m, T.DoubleType(), True) for m in ("rmse", "mae", "r2")])
MODEL_METADATA_SCHEMA = T.StructType([
    T.StructField("model_name", T.StringType()),
    T.StructField("model_type", T.StringType()),
    T.StructField("horizon_hours", T.IntegerType()),
    T.StructField("features", T.ArrayType(T.StringType())),
    T.StructField("metrics", METRICS_STRUCT),
    T.StructField("all_model_metrics", T.MapType(T.StringType(), METRICS_STRUCT)),
    T.StructField("lookback_window", T.IntegerType()),
])


def target_column(horizon_hours: int) -> str:
    return f"aqi_next_{horizon_hours}h"


def feature_columns() -> list[str]:
    return list(FEATURE_COLUMNS)


def ordered_unique(names) -> list[str]:
    return list(dict.fromkeys(names))


def ensure_columns(df: DataFrame, columns, dtype: str = "double") -> DataFrame:
    """Add absent columns as typed NULLs (present ones untouched)."""
    missing = {c: F.lit(None).cast(dtype) for c in columns if c not in df.columns}
    return df.withColumns(missing) if missing else df


def align_columns(df: DataFrame, columns, keep=(), fill: float = 0.0) -> DataFrame:
    """Project exactly ``columns`` in order; absent ones become ``fill`` (present
    NULLs stay NULL)."""
    cols: list[Column] = [F.col(k) for k in keep]
    for c in columns:
        cols.append(F.col(c) if c in df.columns else F.lit(fill).cast("double").alias(c))
    return df.select(*cols)


def numeric_columns(df: DataFrame) -> list[str]:
    numeric = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, numeric)]


def prefixed_columns(df: DataFrame, prefix: str) -> list[str]:
    return [c for c in df.columns if c.startswith(prefix)]


def nan_to_null(df: DataFrame, columns=None) -> DataFrame:
    """NULL is the only missing marker inside the engine."""
    dbl = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    cols = [c for c in (columns or dbl) if c in dbl]
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast("double")).cast(df.schema[c].dataType)
                           for c in cols}) if cols else df
