"""State of a stream in versioned runs.

Micro-batch N writes run (0, N). Sixteen runs of a level are merged into one of the next,
so a reader meets at most fifteen runs of each level, however many batches there were, and
each row is rewritten once per level. Which runs are live before batch N follows from N
alone, and a run is always written whole over its own folder, so a replay of N reads what
N read and writes what N wrote."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

FANOUT = 16


def live(batch: int, fanout: int = FANOUT) -> list[tuple[int, int]]:
    """(level, run) of the runs that hold the state before ``batch``, oldest first."""
    out, level = [], 0
    while batch:
        out = [(level, r) for r in range(batch // fanout * fanout, batch)] + out
        batch, level = batch // fanout, level + 1
    return out


def merges(batch: int, fanout: int = FANOUT) -> list[tuple[tuple[int, int], list[tuple[int, int]]]]:
    """(new run, its parts) of the merges that ``batch``'s own run completes."""
    out, level, done = [], 0, batch + 1
    while done % fanout == 0:
        done //= fanout
        out.append(((level + 1, done - 1), [(level, r) for r in range((done - 1) * fanout, done * fanout)]))
        level += 1
    return out


def folder(root: str, name: str, run: tuple[int, int]) -> str:
    return os.path.join(root, name, f"level={run[0]}", f"run={run[1]}")


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def read(spark: SparkSession, root: str, name: str, runs, schema) -> DataFrame:
    """Rows of the runs with their ``level`` and ``run`` (empty without runs)."""
    paths = [folder(root, name, r) for r in runs]
    paths = [p for p in paths if exists(spark, p)]
    reader = spark.read.option("basePath", os.path.join(root, name)).schema(schema)
    return reader.parquet(*paths) if paths else spark.createDataFrame([], schema)
