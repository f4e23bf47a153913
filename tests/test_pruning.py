"""Scans of the as-of queries are bounded on the raw column; rounding keeps large values."""

import os

import pytest
from pyspark.sql import functions as F

from hourcast.functions.numeric import round_stable
from hourcast.plans import catalog

SF = "/root/testdata/sf0.001"
AS_OF_QUERIES = ["point_count", "alert", "forecast_cards", "trend", "current_or_last", "weather_lookup", "append_row"]


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables absent")
@pytest.mark.parametrize("name", AS_OF_QUERIES)
def test_as_of_queries_push_time_bounds(spark, name):
    df = catalog.QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    bounded = [line for line in scans if "LessThan(ts," in line or "GreaterThanOrEqual(ts," in line]
    # the only unbounded scan left is the one-column maximum that dates the forecast table
    rest = [line for line in scans if line not in bounded]
    assert bounded and all("ReadSchema: struct<ts:timestamp_ntz>" in line for line in rest)


def test_rounding_keeps_large_values(spark):
    rows = [(1e9, 3), (600000.0, 6), (123456789012.0, 3), (-1e9, 3)]
    for value, scale in rows:
        assert spark.range(1).select(round_stable(F.lit(value), scale)).first()[0] == value
    assert spark.range(1).select(round_stable(F.lit(2.675), 2)).first()[0] == 2.68
    assert spark.range(1).select(round_stable(F.lit(-2.675), 2)).first()[0] == -2.68
    assert spark.range(1).select(round_stable(F.lit(None).cast("double"), 2)).first()[0] is None
