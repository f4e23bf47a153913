"""The newest stored rows of each series, kept beside the feature table.

A micro-batch that continues its series needs the 50 rows before it and nothing older, so
the stream keeps the newest ``TAIL_ROWS`` stored rows of each series as one array, in
versioned runs (see :mod:`hourcast.streaming.runs`): a batch writes the arrays of its own
series, and the newest array of a series is in force."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourcast.schema import SERIES, TS
from hourcast.streaming import runs

TAIL_ROWS = 128


def tail_schema(rows: T.StructType) -> T.StructType:
    """(series, tail): rows of the series but for the series, by time."""
    inner = T.StructType([rows[TS], *[f for f in rows.fields if f.name not in (SERIES, TS)]])
    return T.StructType([T.StructField(SERIES, rows[SERIES].dataType), T.StructField("tail", T.ArrayType(inner))])


def from_table(stored: DataFrame, schema: T.StructType) -> DataFrame:
    """Tails of a table that was not written by the stream."""
    names = [f.name for f in schema["tail"].dataType.elementType.fields]
    w = Window.partitionBy(SERIES).orderBy(F.col(TS).desc())
    newest = stored.select(SERIES, *names).withColumn("_rk", F.row_number().over(w)).filter(F.col("_rk") <= TAIL_ROWS)
    return newest.groupBy(SERIES).agg(F.array_sort(F.collect_list(F.struct(*names))).alias("tail"))


def current(spark: SparkSession, root: str, batch: int, schema: T.StructType) -> DataFrame:
    """(series, tail) before ``batch``."""
    full = T.StructType([*schema.fields, T.StructField("level", T.IntegerType()), T.StructField("run", T.IntegerType())])
    rows = runs.read(spark, root, "tail", runs.live(batch), full)
    # A run of level l ends with batch (run + 1) * fanout^l.
    end = (F.col("run") + 1) * F.pow(F.lit(runs.FANOUT), F.col("level"))
    return rows.groupBy(SERIES).agg(F.max_by("tail", end).alias("tail"))


def store(spark: SparkSession, root: str, batch: int, tails: DataFrame, schema: T.StructType) -> None:
    """Write the tails that ``batch`` changed and do the merges it completes."""
    tails.select(SERIES, "tail").write.mode("overwrite").parquet(runs.folder(root, "tail", (0, batch)))
    full = T.StructType([*schema.fields, T.StructField("level", T.IntegerType()), T.StructField("run", T.IntegerType())])
    for run, parts in runs.merges(batch):
        rows = runs.read(spark, root, "tail", parts, full)
        rows.groupBy(SERIES).agg(F.max_by("tail", "run").alias("tail")).write.mode("overwrite").parquet(runs.folder(root, "tail", run))
