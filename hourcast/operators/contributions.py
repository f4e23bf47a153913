"""Explaining tree ensembles by their node table.

A node table (tree, node, feature, threshold, missing_left, left, right, value, cover) is
exported from boosted models, forests and Spark ML forests alike. Along a row's path through a
tree every step from a node to its child changes the value; the change is the contribution
of the feature that the node tests. Base (the values of all roots) plus contributions is
the prediction of the row, exactly up to rounding. Rows are walked in Arrow batches, all
rows of a batch one step at a time; the node table is broadcast (its size is the model's)."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourcast.operators.boosting import Booster, _matrix, by_values, from_nodes
from hourcast.operators.forest import Forest
from hourcast.schema import SERIES


def forest_nodes(model, features, scratch: str | None = None) -> DataFrame:
    """The node table of a forest, or of a fitted Spark ML tree ensemble, read from its saved
    form; a node's value is its prediction over the number of trees."""
    from pyspark.sql import SparkSession

    from hourcast.session import scratch_path
    if isinstance(model, Forest):
        n, names = F.col("n"), F.array(*[F.lit(c) for c in features])
        arrays = [F.col(c) for c in ("feature", "threshold", "left", "value", "cover")]
        rows = model.nodes.select("tree", F.posexplode(F.arrays_zip(*arrays)).alias("node", "n"))
        inner = n["left"] >= 0
        return rows.select(
            "tree", "node", F.when(inner, F.get(names, n["feature"])).alias("feature"), F.when(inner, n["threshold"]).alias("threshold"),
            F.when(inner, F.lit(False)).alias("missing_left"), F.when(inner, n["left"]).alias("left"), F.when(inner, n["left"] + 1).alias("right"),
            (n["value"] / F.lit(float(model.trees))).alias("value"), n["cover"].alias("cover"))
    spark = SparkSession.active()
    path = scratch or scratch_path(spark, f"forest-{uuid.uuid4().hex}")
    model.write().overwrite().save(path)
    rows = spark.read.parquet(os.path.join(path, "data"))
    weights = list(model.treeWeights)
    share = F.element_at(F.array(*[F.lit(w / (len(weights) if "RandomForest" in type(model).__name__ else 1)) for w in weights]),
                         (F.col("treeID") + 1).cast("int"))
    n, inner = F.col("nodeData"), F.col("nodeData.leftChild") >= 0
    names = F.array(*[F.lit(c) for c in features])
    return rows.select(
        F.col("treeID").cast("int").alias("tree"), n["id"].alias("node"),
        F.when(inner, F.element_at(names, n["split"]["featureIndex"] + 1)).alias("feature"),
        F.when(inner, F.get(n["split"]["leftCategoriesOrThreshold"], F.lit(0))).alias("threshold"),
        F.when(inner, F.lit(False)).alias("missing_left"),
        F.when(inner, n["leftChild"]).alias("left"), F.when(inner, n["rightChild"]).alias("right"),
        (n["prediction"] * share).alias("value"), n["rawCount"].cast("double").alias("cover"))


def ensemble(nodes: DataFrame, features, base: float = 0.0) -> Booster:
    """The ensemble of a node table (collected: its size is the model's)."""
    return from_nodes(nodes.collect(), features, base)


def path_contributions(df: DataFrame, model: Booster) -> DataFrame:
    """``df`` with ``base`` (double), ``contributions`` (a double per feature, in order) and
    ``prediction``. NULL and NaN feature values go the way the node table says."""
    cols = [c for c in df.columns if c not in ("base", "contributions", "prediction")]
    k = len(model.features)
    schema = T.StructType([*df.select(*cols).schema.fields, T.StructField("base", T.DoubleType()),
                           T.StructField("contributions", T.ArrayType(T.DoubleType())), T.StructField("prediction", T.DoubleType())])
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        base = m.base + sum(float(t["value"][0]) for t in m.trees)
        for batch in batches:
            size = batch.num_rows
            if not size:
                continue
            x = _matrix(batch, len(cols), k)
            out = np.zeros((size, k))
            for t in m.trees:
                before = None
                for now in by_values(t, x):
                    if before is not None:
                        rows = np.flatnonzero(now != before)
                        at = before[rows]
                        out[rows, t["feature"][at]] += t["value"][now[rows]] - t["value"][at]
                    before = now
            lists = pa.ListArray.from_arrays(pa.array(np.arange(size + 1, dtype=np.int32) * k), pa.array(out.ravel()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(cols)], pa.array(np.full(size, base)), lists, pa.array(base + out.sum(1))],
                names=[*cols, "base", "contributions", "prediction"])

    return df.select(*cols, *[F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(model.features)]).mapInArrow(run, schema)


def tree_importance(df: DataFrame, model: Booster, series=SERIES) -> DataFrame:
    """Mean absolute contribution of each feature over the rows of each series."""
    names = F.array(*[F.lit(c) for c in model.features])
    each = path_contributions(df, model).select(series, F.explode(F.arrays_zip(names.alias("feature"), F.col("contributions").alias("c"))).alias("z"))
    return each.groupBy(series, F.col("z.feature").alias("feature")).agg(F.avg(F.abs("z.c")).alias("importance"))
