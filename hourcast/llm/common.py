"""Shared helpers of the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourcast.session import checkpoint_root

# White space of the word, key and line definitions: space and U+0009..U+000D.
SPACES = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_CLASS = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of a table of ``sf_dir``."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def materialise(df: DataFrame, tag: str, by: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet below the session's shared checkpoint folder and
    read it back: cuts the lineage, survives lost executors, is computed once.
    ``by`` names a last column to lay the files out by.  ``release`` removes what the
    session has written."""
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/hourcast-llm/{spark.sparkContext.applicationId}/{tag}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path, partitionBy=by)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Delete this session's scratch tables; call it when no result that was
    built on them is still to be read."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{checkpoint_root(spark)}/hourcast-llm/{spark.sparkContext.applicationId}")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def ascii_lower(c):
    """Lower-case A-Z alone (``lower`` where the text is plain ASCII)."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, upper, upper.lower()))
