"""Gradient-boosted regression trees by second-order histograms, for one group of rows or
for many groups (horizons, stations) at once.

* Features are cut into at most ``BINS`` bins at approximate quantiles of the group (a
  mergeable sketch, one pass); a row becomes one byte per feature. NULL and NaN have a bin
  of their own.
* A level of all groups' trees is one job: each task adds up gradients and hessians by
  (group, node, feature, bin) over its rows, a partial aggregate merges the sums, and the
  driver, which sees these sums and never rows, takes each node's best split. Its size is
  nodes x features x bins, whatever the number of rows.
* The margin is a column. Trees grown since it was last written are applied on the fly,
  and every ``REFRESH`` rounds it is written anew, so a row meets at most that many trees
  per level.

Squared error: gradient = margin - y, hessian = 1. A node's value is -G / (H + lambda),
its gain the usual difference of G^2 / (H + lambda). Rows with missing values go to the
side that gains more. Equal gains go to the earlier feature, the lower cut, then left."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BINS = 255
MISSING = 255
REFRESH = 16
ACCURACY = 10_000
SAME_GAIN = 1e-9

# ---- fixed values: defaults of the boosted candidate ------------------------------------------
LAMBDA = 1.0
MIN_CHILD_WEIGHT = 1.0
LEAST_GAIN = 1e-6
# -----------------------------------------------------------------------------------------------

NODE_SCHEMA = T.StructType([
    T.StructField("tree", T.IntegerType()), T.StructField("node", T.IntegerType()), T.StructField("feature", T.StringType()),
    T.StructField("threshold", T.DoubleType()), T.StructField("missing_left", T.BooleanType()), T.StructField("left", T.IntegerType()),
    T.StructField("right", T.IntegerType()), T.StructField("value", T.DoubleType()), T.StructField("cover", T.DoubleType())])


@dataclass
class Tree:
    """Nodes by number; ``left`` is -1 at a leaf. ``cut`` is the last bin that goes left."""
    feature: list[int] = field(default_factory=list)
    cut: list[int] = field(default_factory=list)
    threshold: list[float] = field(default_factory=list)
    missing_left: list[bool] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    cover: list[float] = field(default_factory=list)

    def add(self, value: float, cover: float) -> int:
        for name, v in (("feature", -1), ("cut", 0), ("threshold", 0.0), ("missing_left", False), ("left", -1), ("right", -1),
                        ("value", value), ("cover", cover)):
            getattr(self, name).append(v)
        return len(self.value) - 1

    def arrays(self) -> dict[str, np.ndarray]:
        return {k: np.array(v) for k, v in vars(self).items()}


def walk(tree: dict[str, np.ndarray], n: int, goes_left) -> Iterator[np.ndarray]:
    """The node of each of ``n`` rows, step by step from the root until all are at leaves.
    ``goes_left(rows, nodes)`` decides a step."""
    node = np.zeros(n, np.int64)
    yield node
    while True:
        rows = np.flatnonzero(tree["left"][node] >= 0)
        if not len(rows):
            return
        at = node[rows]
        node = node.copy()
        node[rows] = np.where(goes_left(rows, at), tree["left"][at], tree["right"][at])
        yield node


def _last(steps: Iterator[np.ndarray]) -> np.ndarray:
    for out in steps:
        pass
    return out


def _by_bins(tree: dict[str, np.ndarray], bins: np.ndarray) -> np.ndarray:
    def left(rows, at):
        b = bins[rows, tree["feature"][at]]
        return np.where(b == MISSING, tree["missing_left"][at], b <= tree["cut"][at])
    return _last(walk(tree, len(bins), left))


def by_values(tree: dict[str, np.ndarray], x: np.ndarray) -> Iterator[np.ndarray]:
    """Steps of :func:`walk` for rows of feature values (NaN: missing)."""
    def left(rows, at):
        v = x[rows, tree["feature"][at]]
        return np.where(np.isnan(v), tree["missing_left"][at], v <= tree["threshold"][at])
    return walk(tree, len(x), left)


@dataclass
class Booster:
    """A fitted ensemble: prediction = base + sum of the reached leaves' values."""
    features: list[str]
    base: float
    trees: list[dict[str, np.ndarray]]

    def node_rows(self) -> list[tuple]:
        out = []
        for t, a in enumerate(self.trees):
            for i in range(len(a["value"])):
                inner = a["left"][i] >= 0
                out.append((t, i, self.features[a["feature"][i]] if inner else None, float(a["threshold"][i]) if inner else None,
                            bool(a["missing_left"][i]) if inner else None, int(a["left"][i]) if inner else None,
                            int(a["right"][i]) if inner else None, float(a["value"][i]), float(a["cover"][i])))
        return out

    def narrowed(self, features) -> "Booster":
        """The same model over a list that holds all features its trees test."""
        to = np.array([list(features).index(c) if c in features else -1 for c in self.features])
        return Booster(list(features), self.base, [t | {"feature": np.where(t["left"] >= 0, to[t["feature"]], -1)} for t in self.trees])

    def importances(self) -> list[float]:
        """Share of each feature in the total gain of the splits."""
        total = np.zeros(len(self.features))
        for a in self.trees:
            v2 = a["value"] ** 2 * (a["cover"] + LAMBDA)
            for i in np.flatnonzero(a["left"] >= 0):
                total[a["feature"][i]] += max(v2[a["left"][i]] + v2[a["right"][i]] - v2[i], 0.0)
        return list(total / total.sum()) if total.sum() > 0 else list(total)


def nodes_frame(spark, model: Booster) -> DataFrame:
    """The node table: tree, node, feature, threshold (left if value <= threshold),
    missing_left, left, right, value, cover."""
    return spark.createDataFrame(model.node_rows(), NODE_SCHEMA)


def from_nodes(rows, features, base: float) -> Booster:
    """A model from the rows of its node table."""
    at = {c: i for i, c in enumerate(features)}
    trees: dict[int, Tree] = {}
    for r in sorted(rows, key=lambda r: (r.tree, r.node)):
        t = trees.setdefault(r.tree, Tree())
        i = t.add(r.value, r.cover)
        if r.feature is not None:
            t.feature[i], t.threshold[i], t.missing_left[i], t.left[i], t.right[i] = at[r.feature], r.threshold, r.missing_left, r.left, r.right
    return Booster(list(features), base, [trees[k].arrays() for k in sorted(trees)])


def bin_edges(df: DataFrame, features, keys, bins: int = BINS) -> dict[tuple, tuple[list[np.ndarray], float, int]]:
    """Group -> (each feature's edges, mean of the label, rows). Bin b holds the values
    in (edge[b - 1], edge[b]]."""
    at = [i / bins for i in range(1, bins)]
    rows = df.groupBy(*keys).agg(F.avg("_y").alias("_mean"), F.count(F.lit(1)).alias("_n"),
                                 *[F.percentile_approx(c, at, ACCURACY).alias(c) for c in features]).collect()
    return {tuple(r[k] for k in keys): ([np.unique(np.array(r[c] or [], np.float64)) for c in features], r._mean, r._n) for r in rows}


def _matrix(batch: pa.RecordBatch, first: int, k: int) -> np.ndarray:
    """Columns first .. first + k - 1 as float64, NULL as NaN."""
    return np.column_stack([batch.column(first + i).cast(pa.float64()).fill_null(float("nan")).to_numpy(zero_copy_only=False) for i in range(k)])


def _binned(df: DataFrame, features, group: dict[tuple, int], edges: list, keys) -> DataFrame:
    """(g, y, margin, bins): the group's number, label, margin and a byte per feature."""
    names = ["g", "y", "margin", "bins"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            own = list(zip(*(batch.column(i).to_pylist() for i in range(len(keys))))) if keys else [()] * batch.num_rows
            g = np.array([group[k] for k in own], np.int32)
            x = _matrix(batch, len(keys) + 1, len(features))
            out = np.full(x.shape, MISSING, np.uint8)
            margin = np.zeros(len(g))
            for n in np.unique(g):
                rows = np.flatnonzero(g == n)
                cuts, mean, _ = edges[n]
                margin[rows] = mean
                for j, cut in enumerate(cuts):
                    some = rows[~np.isnan(x[rows, j])]
                    out[some, j] = np.searchsorted(cut, x[some, j], "left")
            yield pa.RecordBatch.from_arrays([
                pa.array(g), batch.column(len(keys)).cast(pa.float64()), pa.array(margin), pa.array([r.tobytes() for r in out], pa.binary())],
                names=names)

    return df.select(*keys, "_y", *features).mapInArrow(run, "g int, y double, margin double, bins binary")


def _rows(batch: pa.RecordBatch, width: int):
    """(g, y, margin, bins) of a batch as arrays."""
    b = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.uint8).reshape(-1, width)
    return *(batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)), b


def _moved(margin: np.ndarray, g: np.ndarray, bins: np.ndarray, fresh: dict[int, list]) -> np.ndarray:
    margin = margin.copy()
    for n, trees in fresh.items():
        rows = np.flatnonzero(g == n)
        for t in trees if len(rows) else ():
            margin[rows] += t["value"][_by_bins(t, bins[rows])]
    return margin


def _histogram(binned: DataFrame, width: int, fresh: dict[int, list], growing: dict[int, tuple[dict, list[int]]]) -> DataFrame:
    """(g, node, feature, bin, grad, hess) summed over the rows of the growing trees' open nodes."""
    names = ["g", "node", "feature", "bin", "grad", "hess"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            g, y, margin, bins = _rows(batch, width)
            for n, (tree, open_nodes) in growing.items():
                rows = np.flatnonzero(g == n)
                if not len(rows):
                    continue
                b = bins[rows]
                grad = _moved(margin[rows], g[rows], b, {n: fresh.get(n, [])}) - y[rows]
                slot = np.full(len(tree["value"]), -1)
                slot[open_nodes] = np.arange(len(open_nodes))
                at = slot[_by_bins(tree, b)]
                inside = at >= 0
                at, b, grad = at[inside], b[inside], grad[inside]
                size = len(open_nodes) * 256
                s = sums.setdefault(n, np.zeros((2, width, size)))
                for j in range(width):
                    key = at * 256 + b[:, j]
                    s[0, j] += np.bincount(key, grad, size)
                    s[1, j] += np.bincount(key, minlength=size)
        for n, s in sums.items():
            j, key = np.nonzero(s[1])
            nodes = np.array(growing[n][1])
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(j), n), pa.int32()), pa.array(nodes[key // 256], pa.int32()), pa.array(j, pa.int32()),
                pa.array(key % 256, pa.int32()), pa.array(s[0, j, key]), pa.array(s[1, j, key])], names=names)

    part = binned.mapInArrow(run, "g int, node int, feature int, bin int, grad double, hess double")
    return part.groupBy("g", "node", "feature", "bin").agg(F.sum("grad").alias("grad"), F.sum("hess").alias("hess"))


def best_split(grad: np.ndarray, hess: np.ndarray) -> tuple | None:
    """(gain, feature, cut, missing_left, left sums, right sums) of a node from its sums by
    (feature, bin); None where no split gains."""
    best = None
    g, h = grad[0].sum(), hess[0].sum()
    whole = g * g / (h + LAMBDA)
    for missing_left in (True, False):
        gl, hl = np.cumsum(grad[:, :MISSING], 1), np.cumsum(hess[:, :MISSING], 1)
        if missing_left:
            gl, hl = gl + grad[:, MISSING:], hl + hess[:, MISSING:]
        gr, hr = g - gl, h - hl
        gain = gl * gl / (hl + LAMBDA) + gr * gr / (hr + LAMBDA) - whole
        # A cut between two bins with rows: an empty bin's cut is its lower neighbour's.
        ok = (hl >= MIN_CHILD_WEIGHT) & (hr >= MIN_CHILD_WEIGHT) & (hess[:, :MISSING] > 0)
        gain = np.where(ok, gain, -np.inf)
        # The first of the gains that are equal but for the order of summation.
        top = gain.max()
        j, cut = np.unravel_index(np.argmax(gain >= top - SAME_GAIN * abs(top)), gain.shape)
        if top > LEAST_GAIN and (best is None or top > best[0] + SAME_GAIN * abs(best[0])):
            best = (float(gain[j, cut]), int(j), int(cut), missing_left, (gl[j, cut], hl[j, cut]), (gr[j, cut], hr[j, cut]))
    return best


def fit_groups(df: DataFrame, features, label: str, groups=(), rounds: int = 300, step: float = 0.05, depth: int = 6,
               bins: int = BINS) -> dict[tuple, Booster]:
    """Group key (a tuple; () without groups) -> its model. Rows without a label are left
    out; a group without rows has no model. Trees of all groups grow in the same jobs."""
    from hourcast.session import reliable_checkpoint
    keys, features = list(groups), list(features)
    data = df.select(*keys, F.col(label).cast("double").alias("_y"),
                     *[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(c) for c in features])
    data = data.filter(F.col("_y").isNotNull() & ~F.isnan("_y"))
    found = bin_edges(data, features, keys, bins)
    if not found:
        return {}
    order = sorted(found, key=str)
    edges = [found[k] for k in order]
    models = [Booster(features, e[1], []) for e in edges]
    binned = reliable_checkpoint(_binned(data, features, {k: i for i, k in enumerate(order)}, edges, keys)).persist()
    fresh: dict[int, list] = {i: [] for i in range(len(order))}
    width = len(features)
    for r in range(rounds):
        trees = {}
        for i, e in enumerate(edges):
            trees[i] = Tree()
            trees[i].add(0.0, float(e[2]))
        front = {i: [0] for i in trees}
        for _ in range(depth):
            growing = {i: (trees[i].arrays(), nodes) for i, nodes in front.items() if nodes}
            if not growing:
                break
            sums = _histogram(binned, width, fresh, growing).toArrow()
            g, node, feature, b, grad, hess = (sums.column(k).to_numpy() for k in range(6))
            front = {}
            for i, (_, nodes) in growing.items():
                tree, mine = trees[i], g == i
                table = np.zeros((2, len(tree.value), width, 256))
                table[0, node[mine], feature[mine], b[mine]] = grad[mine]
                table[1, node[mine], feature[mine], b[mine]] = hess[mine]
                for k in nodes:
                    if k == 0:
                        total = table[:, 0, 0].sum(1)
                        tree.value[0] = -step * total[0] / (total[1] + LAMBDA)
                    split = best_split(table[0, k], table[1, k])
                    if split is None:
                        continue
                    _, j, cut, missing_left, *sides = split
                    cuts = edges[i][0][j]
                    tree.feature[k], tree.cut[k], tree.missing_left[k] = j, cut, missing_left
                    # Above the last edge only missing values are left.
                    tree.threshold[k] = float(cuts[cut]) if cut < len(cuts) else float("inf")
                    tree.left[k], tree.right[k] = (tree.add(-step * a / (w + LAMBDA), float(w)) for a, w in sides)
                    front.setdefault(i, []).extend((tree.left[k], tree.right[k]))
        grown = {i: t.arrays() for i, t in trees.items()}
        for i, t in grown.items():
            models[i].trees.append(t)
            fresh[i].append(t)
        if (r + 1) % REFRESH == 0 and r + 1 < rounds:
            done, now = binned, fresh
            binned = reliable_checkpoint(_refreshed(binned, width, now)).persist()
            done.unpersist()
            fresh = {i: [] for i in fresh}
    binned.unpersist()
    return dict(zip(order, models))


def _refreshed(binned: DataFrame, width: int, fresh: dict[int, list]) -> DataFrame:
    """``binned`` with the margins moved by the fresh trees."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                g, _, margin, bins = _rows(batch, width)
                yield batch.set_column(2, "margin", pa.array(_moved(margin, g, bins, fresh)))

    return binned.mapInArrow(run, binned.schema)


def predict_groups(df: DataFrame, models: dict[tuple, Booster], groups=()) -> DataFrame:
    """``df`` with ``prediction`` of its group's model (NULL where the group has none)."""
    keys = list(groups)
    features = next(iter(models.values())).features if models else []
    cols = [c for c in df.columns if c != "prediction"]
    schema = T.StructType([*df.select(*cols).schema.fields, T.StructField("prediction", T.DoubleType())])
    shared = df.sparkSession.sparkContext.broadcast(models)  # trees: rounds x 2^depth nodes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            own = list(zip(*(batch.column(c).to_pylist() for c in keys))) if keys else [()] * batch.num_rows
            x = _matrix(batch, len(cols), len(features)) if features else np.zeros((batch.num_rows, 0))
            out = np.full(batch.num_rows, np.nan)
            for k in set(own):
                model = shared.value.get(k)
                if model is not None:
                    rows = np.array([i for i, o in enumerate(own) if o == k])
                    out[rows] = model.base + sum((t["value"][_last(by_values(t, x[rows]))] for t in model.trees), np.zeros(len(rows)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(cols)], pa.array(out, pa.float64(), mask=np.isnan(out))],
                                             schema=pa.schema([*list(batch.schema)[:len(cols)], pa.field("prediction", pa.float64())]))

    return df.select(*cols, *[F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(features)]).mapInArrow(run, schema)
