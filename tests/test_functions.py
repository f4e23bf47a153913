import math

import pytest
from pyspark.sql import functions as F

from hourcast.functions import aqi as A
from hourcast.functions.calendar import add_calendar, local_time


def _eval(spark, values, fn):
    df = spark.createDataFrame([(i, None if v is None else float(v)) for i, v in enumerate(values)], "i int, x double")
    return [r[0] for r in df.orderBy("i").select(fn("x")).collect()]


def test_aqi_continuous_edges(spark):
    xs = [None, -1, 0, 12.0, 12.05, 12.1, 35.4, 35.5, 55.4, 150.4, 250.4, 350.4, 500.4, 500.5]
    got = _eval(spark, xs, A.pm25_to_aqi)
    exp = [None, 0, 0, 50, None, 51, 100, 101, 150, 200, 300, 400, 500, 501]
    for g, e, x in zip(got, exp, xs):
        if x == 12.05:
            assert g == pytest.approx(50.8948, abs=1e-4)
        elif e is None:
            assert g is None
        else:
            assert g == pytest.approx(e, abs=1e-9)


def test_aqi_rounded_edges(spark):
    xs = [None, -1, 0, 12.0, 12.05, 12.1, 35.4, 250.5, 500.4, 500.5]
    got = _eval(spark, xs, A.pm25_to_aqi_rounded)
    assert got == [None, 500.0, 0.0, 50.0, 500.0, 51.0, 100.0, 301.0, 500.0, 500.0]


def test_category_edges(spark):
    got = _eval(spark, [50, 50.1, 100, 150, 200, 300, 300.1, None], A.aqi_category)
    assert got == ["Good", "Moderate", "Moderate", "Unhealthy for Sensitive Groups", "Unhealthy",
                   "Very Unhealthy", "Hazardous", "Hazardous"]


def test_sql_functions_match_columns(spark):
    A.register_sql_functions(spark)
    r = spark.sql("SELECT pm25_to_aqi(12.05D) a, pm25_to_aqi_rounded(12.05D) b, aqi_category(CAST(NULL AS DOUBLE)) c").first()
    assert r.a == pytest.approx(50.8948, abs=1e-4) and r.b == 500.0 and r.c == "Hazardous"


def test_calendar_and_local_parts(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00",), ("2024-01-07 23:00:00",)], "t string") \
        .select(F.col("t").cast("timestamp_ntz").alias("timestamp"))
    out = add_calendar(df).withColumn("lt", local_time("timestamp")).orderBy("timestamp").collect()
    assert [r.day_of_week for r in out] == [0, 6]
    assert str(out[0].lt) == "2024-01-01 05:00:00" and str(out[1].lt) == "2024-01-08 04:00:00"


def test_cyclical_values(spark):
    from hourcast.functions.calendar import add_cyclical
    df = spark.createDataFrame([(6, 0)], "hour_of_day long, day_of_week long")
    r = add_cyclical(df).first()
    assert r.hour_sin == pytest.approx(1.0) and r.hour_cos == pytest.approx(0.0, abs=1e-12)
    assert r.dow_sin == 0.0 and r.dow_cos == 1.0
    assert math.isclose(r.hour_sin, math.sin(2 * math.pi * 6 / 24))
