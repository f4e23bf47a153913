"""hourcast: Spark-native hourly time-series feature, forecasting and profiling engine.

Every public operator takes and returns a ``pyspark.sql.DataFrame``; series key,
time column, measure columns, time zone and ``as_of`` instants are parameters.
"""

__version__ = "0.1.0"
