from datetime import datetime, timedelta

T0 = datetime(2024, 1, 1, 0, 0, 0)


def hours(n):
    return T0 + timedelta(hours=n)


def series_frame(spark, rows, schema="series string, timestamp timestamp_ntz, aqi double"):
    return spark.createDataFrame(rows, schema)


def col(df, name, order=("series", "timestamp")):
    return [r[name] for r in df.orderBy(*order).collect()]
