"""Ridge regression from shared sufficient statistics.

One pass over the rows adds up, for every group (horizon, station) at once, the count, the
sums and the products of all features and of the label: a task emits one row per group and
pair of columns, and a partial aggregate merges them. Products are taken about a first
centre (the group's means, from a first small aggregate), so that large offsets cost no
digits. Each group's normal equations are solved for its own features from the same sums,
so a feature list more or another alpha needs no further pass. The driver sees the square
of the number of columns for each group, never rows."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass
class LinearModel:
    features: list[str]
    coefficients: list[float]
    intercept: float

    def column(self) -> Column:
        """The prediction as an expression; NULL where a feature is NULL."""
        out = F.lit(float(self.intercept))
        for c, w in zip(self.features, self.coefficients):
            out = out + F.col(c) * F.lit(float(w))
        return out


@dataclass
class Moments:
    """Of one group: rows, means and centred products of ``columns`` (the label is last)."""
    columns: list[str]
    n: int
    mean: np.ndarray
    products: np.ndarray


def moments(df: DataFrame, features, label: str, groups=()) -> dict[tuple, Moments]:
    """Group key (a tuple; () without groups) -> moments of its rows. Rows with a NULL
    label are left out; a NULL feature counts as its group's mean, so a column that a
    group has not got has zero products there."""
    keys, cols = list(groups), [*features, "_y"]
    data = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in features], F.col(label).cast("double").alias("_y"))
    data = data.filter(F.col("_y").isNotNull())
    first = data.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *[F.avg(c).alias(c) for c in cols]).collect()
    first = [r for r in first if r._n]
    order = [tuple(r[k] for k in keys) for r in first]
    mean = np.array([[np.nan if r[c] is None else r[c] for c in cols] for r in first]).reshape(len(first), len(cols))
    number = {k: i for i, k in enumerate(order)}
    names, width = ["g", "i", "j", "p"], len(cols)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        acc = np.zeros((len(order), width, width))
        for batch in batches:
            if not batch.num_rows:
                continue
            own = list(zip(*(batch.column(i).to_pylist() for i in range(len(keys))))) if keys else [()] * batch.num_rows
            g = np.array([number[k] for k in own])
            x = np.column_stack([batch.column(len(keys) + i).fill_null(float("nan")).to_numpy(zero_copy_only=False) for i in range(width)])
            x = np.nan_to_num(x - mean[g], nan=0.0)
            for k in np.unique(g):
                acc[k] += x[g == k].T @ x[g == k]
        i, j = np.triu_indices(width)
        for k in range(len(order)):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), k), pa.int32()), pa.array(i, pa.int32()), pa.array(j, pa.int32()),
                                              pa.array(acc[k][i, j])], names=names)

    part = data.select(*keys, *cols).mapInArrow(run, "g int, i int, j int, p double")
    products = np.zeros((len(order), width, width))
    for r in part.groupBy("g", "i", "j").agg(F.sum("p").alias("p")).collect():
        products[r.g, r.i, r.j] = products[r.g, r.j, r.i] = r.p
    return {k: Moments(cols, first[n]._n, mean[n], products[n]) for n, k in enumerate(order)}


def ridge(m: Moments, features=None, alpha: float = 1.0) -> LinearModel:
    """Ridge with a free intercept: (X'X + alpha I) w = X'y on centred columns."""
    features = list(features if features is not None else m.columns[:-1])
    at = [m.columns.index(c) for c in features]
    w = np.linalg.solve(m.products[np.ix_(at, at)] + alpha * np.eye(len(at)), m.products[at, -1]) if at else np.zeros(0)
    return LinearModel(features, [float(v) for v in w], float(m.mean[-1] - np.nan_to_num(m.mean[at]) @ w))
