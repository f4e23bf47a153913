"""Parquet table access. Column pruning and predicate pushdown are left to
Catalyst: callers select/filter lazily and the scan's ReadSchema shrinks."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

DEFAULT_SF_DIR = "/root/testdata/sf0.01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
