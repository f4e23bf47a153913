"""PM2.5 -> AQI conversions and AQI category bands as Catalyst CASE chains."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values ----------------------------------------------------------
# Continuous index (concentration lo, hi in ug/m3, index lo, hi); above the last
# band the index is 501, below zero it is 0.
PM25_BANDS_CONTINUOUS = [
    (0.0, 12.0, 0, 50),
    (12.1, 35.4, 51, 100),
    (35.5, 55.4, 101, 150),
    (55.5, 150.4, 151, 200),
    (150.5, 250.4, 201, 300),
    (250.5, 350.4, 301, 400),
    (350.5, 500.4, 401, 500),
]
PM25_ABOVE_SCALE = 501.0
# Rounded index of the hourly append: the two top bands are one line and any
# value outside every closed band (negative, between bands, above) is 500.
PM25_BANDS_ROUNDED = [
    (0.0, 12.0, 0, 50),
    (12.1, 35.4, 51, 100),
    (35.5, 55.4, 101, 150),
    (55.5, 150.4, 151, 200),
    (150.5, 250.4, 201, 300),
    (250.5, 500.4, 301, 500),
]
PM25_OUT_OF_BAND = 500.0
# Category upper bounds (inclusive) with utility colours; above the last: Hazardous.
AQI_CATEGORIES = [
    (50, "Good", "#00e400"),
    (100, "Moderate", "#f97316"),
    (150, "Unhealthy for Sensitive Groups", "#ff7e00"),
    (200, "Unhealthy", "#ff0000"),
    (300, "Very Unhealthy", "#8f3f97"),
]
AQI_TOP_CATEGORY = ("Hazardous", "#7e0023")
# ---------------------------------------------------------------------------


def _line(x: Column, lo: float, hi: float, ilo: int, ihi: int) -> Column:
    return F.lit((ihi - ilo) / (hi - lo)) * (x - F.lit(lo)) + F.lit(float(ilo))


def _missing(x: Column) -> Column:
    return x.isNull() | F.isnan(x.cast("double"))


def pm25_to_aqi(pm25) -> Column:
    """Continuous AQI (unrounded). NULL and NaN -> NULL; <0 -> 0; a value between two
    bands takes the next band's line; above the scale -> 501."""
    x = F.col(pm25) if isinstance(pm25, str) else pm25
    expr = F.when(_missing(x), F.lit(None).cast("double")).when(x < 0, F.lit(0.0))
    for lo, hi, ilo, ihi in PM25_BANDS_CONTINUOUS:
        expr = expr.when(x <= hi, _line(x, lo, hi, ilo, ihi))
    return expr.otherwise(F.lit(PM25_ABOVE_SCALE))


def pm25_to_aqi_rounded(pm25) -> Column:
    """Rounded AQI (half-even to an integer, always DOUBLE). Only values inside a
    closed band get a line; everything else (negative, gaps, above) -> 500."""
    x = F.col(pm25) if isinstance(pm25, str) else pm25
    expr = F.when(_missing(x), F.lit(None).cast("double"))
    for lo, hi, ilo, ihi in PM25_BANDS_ROUNDED:
        expr = expr.when((x >= lo) & (x <= hi), F.bround(_line(x, lo, hi, ilo, ihi), 0))
    return expr.otherwise(F.lit(PM25_OUT_OF_BAND))


def _category(aqi, pick: int) -> Column:
    x = F.col(aqi) if isinstance(aqi, str) else aqi
    expr = None
    for bound, name, color in AQI_CATEGORIES:
        val = F.lit(name if pick == 0 else color)
        expr = F.when(x <= bound, val) if expr is None else expr.when(x <= bound, val)
    # NULL (and NaN) fail every comparison and fall to the top category
    return expr.otherwise(F.lit(AQI_TOP_CATEGORY[pick]))


def aqi_category(aqi) -> Column:
    return _category(aqi, 0)


def aqi_color(aqi) -> Column:
    return _category(aqi, 1)


def aqi_category_struct(aqi) -> Column:
    return F.struct(aqi_category(aqi).alias("category"), aqi_color(aqi).alias("color"))


def threshold_label(x, bounds, labels, descending: bool = False) -> Column:
    """Generic colour/threshold bin: first ``x <= bound`` (or ``>=`` when
    ``descending``) wins; ``labels`` has one more entry than ``bounds``."""
    c = F.col(x) if isinstance(x, str) else x
    expr = None
    for b, lab in zip(bounds, labels):
        cond = (c >= b) if descending else (c <= b)
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr.otherwise(F.lit(labels[-1]))


def register_sql_functions(spark) -> None:
    """Expose the AQI conversions to SQL as temporary SQL functions."""
    def case_sql(bands, rounded: bool) -> str:
        parts = ["CASE WHEN x IS NULL OR isnan(x) THEN CAST(NULL AS DOUBLE)"]
        if not rounded:
            parts.append("WHEN x < 0 THEN 0.0D")
        for lo, hi, ilo, ihi in bands:
            line = f"({(ihi - ilo) / (hi - lo)!r}D * (x - {lo!r}D) + {float(ilo)!r}D)"
            if rounded:
                parts.append(f"WHEN x >= {lo!r}D AND x <= {hi!r}D THEN bround({line}, 0)")
            else:
                parts.append(f"WHEN x <= {hi!r}D THEN {line}")
        parts.append(f"ELSE {PM25_OUT_OF_BAND if rounded else PM25_ABOVE_SCALE!r}D END")
        return " ".join(parts)

    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION pm25_to_aqi(x DOUBLE) RETURNS DOUBLE RETURN "
              + case_sql(PM25_BANDS_CONTINUOUS, False))
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION pm25_to_aqi_rounded(x DOUBLE) RETURNS DOUBLE RETURN "
              + case_sql(PM25_BANDS_ROUNDED, True))
    cat = " ".join(f"WHEN a <= {b} THEN '{n}'" for b, n, _ in AQI_CATEGORIES)
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION aqi_category(a DOUBLE) RETURNS STRING RETURN "
              f"CASE {cat} ELSE '{AQI_TOP_CATEGORY[0]}' END")
