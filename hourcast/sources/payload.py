"""Landed API payloads: one JSON object per fetch with an ``hourly`` object of
parallel arrays (``time[]``, ``pm2_5[]`` ...). Parsing is ``from_json`` +
``inline(arrays_zip(...))``: no Python, one row per array position."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourcast.functions.aqi import pm25_to_aqi
from hourcast.functions.numeric import coerce_double
from hourcast.schema import SERIES, TS

# ---- fixed values: source field -> canonical column ---------------------------
AIR_FIELDS = [("pm2_5", "pm25"), ("pm10", "pm10"), ("carbon_monoxide", "co"),
              ("nitrogen_dioxide", "no2"), ("sulphur_dioxide", "so2"), ("ozone", "o3")]
WEATHER_FIELDS = [("temperature_2m", "temperature"), ("relative_humidity_2m", "humidity"),
                  ("wind_speed_10m", "wind_speed")]
FORECAST_FIELDS = [("pm2_5", "fc_pm25"), ("carbon_monoxide", "fc_co"), ("nitrogen_dioxide", "fc_no2"),
                   ("sulphur_dioxide", "fc_so2"), ("ozone", "fc_o3"), ("dust", "fc_dust"), ("uv_index", "fc_uvi")]
TIME_FORMAT = "yyyy-MM-dd'T'HH:mm"
# -------------------------------------------------------------------------------


def payload_schema(fields) -> T.StructType:
    arrays = [T.StructField("time", T.ArrayType(T.StringType()))]
    arrays += [T.StructField(src, T.ArrayType(T.StringType())) for src, _ in fields]
    return T.StructType([T.StructField(SERIES, T.StringType()),
                         T.StructField("hourly", T.StructType(arrays))])


def parse_payload(raw: DataFrame, fields, json_col: str = "payload") -> DataFrame:
    """JSON text -> one row per hour: series, timestamp, canonical measures
    (unparsable -> NULL; a field missing from the payload -> NULL column)."""
    parsed = raw.select(F.from_json(json_col, payload_schema(fields)).alias("p")).select("p.*")
    zipped = F.arrays_zip(F.col("hourly.time").alias("time"),
                          *[F.col(f"hourly.{src}").alias(src) for src, _ in fields])
    rows = parsed.select(SERIES, F.inline(zipped))
    return rows.select(
        SERIES,
        F.try_to_timestamp(F.col("time"), F.lit(TIME_FORMAT)).cast("timestamp_ntz").alias(TS),
        *[coerce_double(src).alias(dst) for src, dst in fields],
    )


def parse_air_payload(raw: DataFrame, json_col: str = "payload") -> DataFrame:
    rows = parse_payload(raw, AIR_FIELDS, json_col)
    return rows.withColumn("aqi", pm25_to_aqi("pm25"))


def build_payloads(hourly: DataFrame, fields, series=SERIES, ts=TS) -> DataFrame:
    """Encode an hourly frame as one landed payload per (series, day), the way an
    API returns a day of readings. NULL measures are landed as the junk token
    ``n/a`` so the parser's coercion is exercised."""
    day = F.to_date(ts)
    entry = F.struct(F.date_format(ts, TIME_FORMAT).alias("time"),
                     *[F.coalesce(F.col(dst).cast("string"), F.lit("n/a")).alias(src) for src, dst in fields])
    per_day = hourly.groupBy(series, day.alias("_day")).agg(F.array_sort(F.collect_list(entry)).alias("_e"))
    def field(name):
        return F.transform("_e", lambda e: e[name]).alias(name)

    hourly_obj = F.struct(field("time"), *[field(src) for src, _ in fields])
    return per_day.select(F.to_json(F.struct(F.col(series).alias(SERIES), hourly_obj.alias("hourly"))).alias("payload"))


LANDING_PARTITION = "day"


def land_payloads(hourly: DataFrame, fields, path: str, series=SERIES, ts=TS) -> None:
    """Write one JSON payload per (series, day) as JSON lines, partitioned by day
    (the layout an hourly/daily fetcher lands)."""
    payloads = build_payloads(hourly, fields, series, ts)
    with_day = payloads.withColumn(LANDING_PARTITION, F.get_json_object("payload", "$.hourly.time[0]").substr(1, 10))
    with_day.write.mode("append").partitionBy(LANDING_PARTITION).json(path)


def read_landed(spark, path: str, fields, start: str, end: str) -> DataFrame:
    """Date-ranged historical scan: only the day partitions in [start, end] are
    listed and read (partition pruning), then payloads are parsed to rows."""
    schema = T.StructType([T.StructField("payload", T.StringType()),
                           T.StructField(LANDING_PARTITION, T.StringType())])
    raw = spark.read.schema(schema).json(path)
    raw = raw.filter((F.col(LANDING_PARTITION) >= F.lit(start)) & (F.col(LANDING_PARTITION) <= F.lit(end)))
    return parse_payload(raw, fields)
