"""Random forests of regression trees, for one group of rows or for many groups (horizons,
stations) at once: the trees of Spark ML's forest (variance, all features at each node,
``max_bins`` quantile cuts, the same draws), grown without dense statistics of every node
in one place.

* Cuts are made of a group's values, as Spark ML makes them: of all rows up to
  ``CUT_ROWS``, of a sample of that size above. A row becomes one small number per feature.
* A node of more than ``LOCAL_ROWS`` drawn rows is split by a job for the level of all
  trees: tasks add up count, sum and sum of squares by (group, tree, node, feature, bin)
  over their rows, a partial aggregate merges them, and the driver, which sees these sums
  and never rows, takes the best split.
* A smaller node's rows meet in one task, which grows all that is below it level by level,
  ``memory_mb`` of statistics at a time.
* A model is a stored table with a row per tree. The driver holds the nodes above the small
  ones while they grow, and nothing of a model afterwards, in prediction or registry: rows
  to predict meet some trees at a time, and a row's sums over them are added up in order.

Equal gains go to the earlier feature, then the lower cut."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourcast.operators.boosting import _last, _matrix, by_values, walk
from hourcast.operators.draws import Well19937c

CUT_ROWS = 10_000
LOCAL_ROWS = 50_000
TREES_AT_ONCE = 25       # of a prediction's task
ROWS_AT_ONCE = 100_000
PURE = 2.0 ** -52

TREE_SCHEMA = "tree int, feature array<int>, threshold array<double>, left array<int>, value array<double>, cover array<double>"
PIECE_SCHEMA = f"g int, tree int, node int, {TREE_SCHEMA.removeprefix('tree int, ')}"
_ARRAYS = {"feature": np.int32, "threshold": np.float64, "left": np.int32, "value": np.float64, "cover": np.float64}


@dataclass
class Forest:
    """``nodes`` has a row per tree, its arrays an item per node: the feature's place in
    ``features``, the threshold (left if value <= threshold), the left child (the right one
    is the next; -1 at a leaf), mean label and number of drawn rows. A prediction is the
    mean of the reached leaves' values."""
    features: list[str]
    trees: int
    nodes: DataFrame

    def importances(self) -> list[float]:
        """Share of each feature in a tree's fall of squared error, averaged over the trees."""
        width = len(self.features)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for t in _trees(batch):
                    fall, inner = np.zeros(width), t["left"] >= 0
                    error = t["cover"] * t["value"] ** 2
                    left = t["left"][inner]
                    np.add.at(fall, t["feature"][inner], error[left] + error[left + 1] - error[inner])
                    yield pa.RecordBatch.from_arrays([pa.array(np.arange(width, dtype=np.int32)), pa.array(fall / fall.sum() if fall.sum() > 0 else fall)],
                                                     names=["f", "share"])

        total = np.zeros(width)
        for r in self.nodes.mapInArrow(run, "f int, share double").groupBy("f").agg(F.sum("share").alias("share")).collect():
            total[r.f] = r.share
        return list(total / total.sum()) if total.sum() > 0 else list(total)


def _trees(batch: pa.RecordBatch | pa.Table) -> list[dict[str, np.ndarray]]:
    """The trees of rows of a node table, by number."""
    found = []
    for r in range(batch.num_rows):
        t = {c: np.asarray(batch.column(c)[r].values, kind) for c, kind in _ARRAYS.items()}
        found.append(t | {"tree": batch.column("tree")[r].as_py(), "right": t["left"] + 1, "missing_left": np.zeros(len(t["left"]), bool)})
    return sorted(found, key=lambda t: t["tree"])


def cuts(values: np.ndarray, splits: int) -> np.ndarray:
    """At most ``splits`` cuts in the middle between neighbours among the values: all of
    them, or those nearest to equal shares of the rows."""
    v, counts = np.unique(values + 0.0, return_counts=True)
    middle = (v[:-1] + v[1:]) / 2.0
    if len(middle) <= splits:
        return middle
    stride = target = len(values) / (splits + 1)
    done, out = np.cumsum(counts).tolist(), []
    for i, m in enumerate(middle.tolist()):
        if abs(done[i] - target) < abs(done[i + 1] - target):
            out.append(m)
            target += stride
    return np.array(out)


def _numbers(batch: pa.RecordBatch, keys, number: dict[tuple, int]) -> np.ndarray:
    own = list(zip(*(batch.column(i).to_pylist() for i in range(len(keys))))) if keys else [()] * batch.num_rows
    return np.array([number[k] for k in own], np.int32)


def _cuts(data: DataFrame, keys, number: dict[tuple, int], sizes: list[int], own: list[list[int]], max_bins: int, seed: int) -> list[list[np.ndarray]]:
    """By group and place in its feature list. Up to CUT_ROWS rows of a group meet, a feature at a time."""
    width = len(data.columns) - len(keys) - 1

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some = np.random.default_rng([seed, TaskContext.get().partitionId()])
        for batch in batches:
            g, x = _numbers(batch, keys, number), _matrix(batch, len(keys) + 1, width)
            for n in np.unique(g).tolist():
                rows = np.flatnonzero(g == n)
                if sizes[n] > CUT_ROWS:
                    rows = rows[some.random(len(rows)) < CUT_ROWS / sizes[n]]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(own[n]), n, np.int32)), pa.array(np.arange(len(own[n]), dtype=np.int32)),
                    pa.array([x[rows, j].tobytes() for j in own[n]], pa.binary())], names=["g", "f", "values"])

    def merge(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        g = key[0].as_py()
        found = cuts(np.frombuffer(b"".join(t.column("values").to_pylist())), min(max_bins, sizes[g]) - 1)
        return pa.table({"g": pa.array([g], pa.int32()), "f": pa.array([key[1].as_py()], pa.int32()), "cuts": pa.array([found.tolist()], pa.list_(pa.float64()))})

    out = [[np.zeros(0)] * len(f) for f in own]
    part = data.mapInArrow(values, "g int, f int, values binary")
    for r in part.groupBy("g", "f").applyInArrow(merge, "g int, f int, cuts array<double>").collect():
        out[r.g][r.f] = np.array(r.cuts)
    return out


def _binned(data: DataFrame, keys, number: dict[tuple, int], own: list[list[int]], edges: list[list[np.ndarray]], kind: str, trees: int, seed: int,
            bootstrap: bool) -> DataFrame:
    """(g, at, y, bins, drawn): the group's number, the row's place, label, a number per
    feature of the group and how often each tree takes the row."""
    width = len(data.columns) - len(keys) - 1
    names = ["g", "at", "y", "bins", "drawn"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at, generators = TaskContext.get().partitionId(), 0, {}
        for batch in batches:
            if not batch.num_rows:
                continue
            g, x, y = _numbers(batch, keys, number), _matrix(batch, len(keys) + 1, width), _matrix(batch, len(keys), 1)[:, 0]
            place = (part << 33) + at + np.arange(len(g))
            at += len(g)
            for n in np.unique(g).tolist():
                rows = np.flatnonzero(g == n)
                mine = x[np.ix_(rows, own[n])]
                if np.isnan(mine).any() or np.isnan(y[rows]).any():
                    raise ValueError("a forest takes no missing values in features or label")
                bins = np.column_stack([np.searchsorted(c, mine[:, j], "left") for j, c in enumerate(edges[n])]).astype(kind)
                if bootstrap and n not in generators:
                    generators[n] = Well19937c(seed + part + 1)
                drawn = generators[n].poisson(len(rows) * trees) if bootstrap else np.ones(len(rows) * trees, np.uint8)
                yield pa.RecordBatch.from_arrays([
                    pa.array(g[rows]), pa.array(place[rows]), pa.array(y[rows]), pa.array([r.tobytes() for r in bins], pa.binary()),
                    pa.array([r.tobytes() for r in drawn.reshape(-1, trees)], pa.binary())], names=names)

    return data.mapInArrow(run, "g int, at long, y double, bins binary, drawn binary")


def _rows(batch: pa.RecordBatch, kind: str, trees: int) -> Iterator[tuple]:
    """By group: (group, first place, labels, bins, draws)."""
    g, at, y = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
    for n in np.unique(g).tolist():
        rows = np.flatnonzero(g == n)
        bins, drawn = (np.frombuffer(b"".join(batch.column(c).take(pa.array(rows)).to_pylist()), k).reshape(len(rows), -1) for c, k in ((3, kind), (4, "u1")))
        yield n, int(at[rows[0]]), y[rows], bins, drawn


def _impurity(s: np.ndarray) -> np.ndarray:
    """Variance of (count, sum, sum of squares) along the first axis."""
    return (s[2] - s[1] * s[1] / s[0]) / s[0]


def best_splits(sums: np.ndarray, splits: np.ndarray, stats: np.ndarray, root: bool) -> tuple:
    """Of nodes' ``sums`` (3, node, feature, bin) and ``stats`` (3, node; a root's are taken
    from the sums): (gain, feature, last bin of the left side, left stats, right stats, stats)."""
    up = np.cumsum(sums, 3)
    left, total = up[..., :-1], up[..., -1:]
    right = total - left
    usable = np.arange(left.shape[3]) < splits[:, None]
    if root:
        first = int(np.argmax(splits > 0))
        stats = left[:, :, first, 0] + right[:, :, first, 0] if usable.any() else total[:, :, first, 0]
    if not usable.any():
        none = np.zeros(stats.shape[1], int)
        return none - np.inf, none, none, stats, stats, stats
    with np.errstate(divide="ignore", invalid="ignore"):
        whole = left[0] + right[0]
        gain = _impurity(stats)[:, None, None] - left[0] / whole * _impurity(left) - right[0] / whole * _impurity(right)
    ok = usable & (left[0] >= 1) & (right[0] >= 1) & (gain >= 0)
    gain = np.where(ok, gain, -np.inf).reshape(len(gain), -1)
    top = gain.argmax(1)
    node, (f, cut) = np.arange(len(gain)), np.divmod(top, left.shape[3])
    return gain[node, top], f, cut, left[:, node, f, cut], right[:, node, f, cut], stats


class Growing:
    """A tree, or what is below a node, while it grows: nodes in order of their level.
    ``open`` are the nodes of the last level that may be split."""

    def __init__(self, stats: np.ndarray | None, level: int, depth: int):
        self.level, self.depth, self.root = level, depth, stats is None
        self.stats = np.zeros((3, 1)) if stats is None else np.asarray(stats, float).reshape(3, 1)
        self.feature, self.cut, self.left, self.levels = np.zeros(1, int), np.zeros(1, int), np.full(1, -1), np.full(1, level)
        self.open = self._splittable(self.stats) if not self.root else np.zeros(int(level < depth), int)

    def _splittable(self, stats: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.abs(_impurity(stats)) >= PURE) if self.level < self.depth else np.zeros(0, int)

    def split(self, gain, f, cut, left, right, stats) -> None:
        """The open nodes' best splits; opens their children."""
        self.stats[:, self.open] = stats
        does = gain > 0
        at, n = self.open[does], len(self.left)
        self.level += 1
        self.feature[at], self.cut[at], self.left[at] = f[does], cut[does], n + 2 * np.arange(len(at))
        # A node's two children stand side by side.
        new = np.stack([left[:, does], right[:, does]], 2).reshape(3, -1)
        self.stats = np.concatenate([self.stats, new], 1)
        more = np.zeros(new.shape[1], int)
        self.feature, self.cut, self.left, self.levels = (np.concatenate([a, more + b]) for a, b in (
            (self.feature, 0), (self.cut, 0), (self.left, -1), (self.levels, self.level)))
        self.open = n + self._splittable(new)
        self.root = False

    def at(self, bins: np.ndarray) -> np.ndarray:
        """The node of each row."""
        t = {"left": self.left, "right": self.left + 1}
        return _last(walk(t, len(bins), lambda rows, at: bins[rows, self.feature[at]] <= self.cut[at]))

    def arrays(self, edges: list[np.ndarray]) -> dict[str, np.ndarray]:
        width = max([1, *(len(c) for c in edges)])
        table = np.zeros((max(len(edges), 1), width))
        for j, c in enumerate(edges):
            table[j, :len(c)] = c
        c = self.stats[0]
        return {"feature": np.where(self.left >= 0, self.feature, -1), "threshold": np.where(self.left >= 0, table[self.feature, self.cut], 0.0),
                "left": self.left, "value": np.divide(self.stats[1], c, out=np.zeros(len(c)), where=c > 0), "cover": c}


def pruned(t: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Without splits into two leaves of one value, the nodes numbered anew."""
    left, value, some = t["left"].copy(), t["value"].copy(), False
    while True:
        inner = np.flatnonzero(left >= 0)
        a = left[inner]
        same = inner[(left[a] < 0) & (left[a + 1] < 0) & (value[a] == value[a + 1])]
        if not len(same):
            break
        value[same], some = value[left[same]], True
        left[same] = -1
    if not some:
        return t
    keep = np.zeros(len(left), bool)
    keep[0] = True
    for i in np.flatnonzero(left >= 0):  # parents stand before their children
        keep[left[i]] = keep[left[i] + 1] = keep[i]
    to, leaf = np.cumsum(keep) - 1, left < 0
    return {"feature": np.where(leaf, -1, t["feature"])[keep], "threshold": np.where(leaf, 0.0, t["threshold"])[keep],
            "left": np.where(leaf, -1, to[left])[keep], "value": value[keep], "cover": t["cover"][keep]}


def _at_once(width: int, bins: int, memory_mb: float) -> int:
    """Nodes whose statistics, and what is made of them, are in memory at a time."""
    return max(1, int(memory_mb * 1e6 / (8 * 16 * max(1, width * bins))))


def grow(y: np.ndarray, drawn: np.ndarray, bins: np.ndarray, edges: list[np.ndarray], depth: int, memory_mb: float,
         stats: np.ndarray | None = None, level: int = 0) -> Growing:
    """The tree of rows taken ``drawn`` times, or what is below a node of ``stats`` at ``level``."""
    splits = np.array([len(c) for c in edges], int)
    width, size = len(edges), int(splits.max(initial=0)) + 1
    w = drawn.astype(float)
    parts = np.stack([w, w * y, w * y * y])
    t = Growing(stats, level, depth)
    if t.root:
        t.stats = np.array([[sum(p.tolist())] for p in parts])
    here = np.zeros(len(y), int)
    step = _at_once(width, size, memory_mb)
    while len(t.open):
        slot = np.full(len(t.left), -1)
        slot[t.open] = np.arange(len(t.open))
        of = slot[here]
        rows = np.argsort(of, kind="stable")[np.count_nonzero(of < 0):]
        ends = np.searchsorted(of[rows], np.arange(0, len(t.open) + step, step))
        found = []
        for first, a, b in zip(range(0, len(t.open), step), ends, ends[1:]):
            some, n = rows[a:b], min(step, len(t.open) - first)
            key = (((of[some] - first)[:, None] * width + np.arange(width)) * size + bins[some]).ravel()
            sums = np.stack([np.bincount(key, np.repeat(p[some], width), n * width * size) for p in parts]).reshape(3, n, width, size)
            found.append(best_splits(sums, splits, t.stats[:, t.open[first:first + n]], t.root))
        t.split(*(np.concatenate(x, axis=-1) for x in zip(*found)))
        inside = np.flatnonzero(t.left[here] >= 0)
        n = here[inside]
        here[inside] = t.left[n] + (bins[inside, t.feature[n]] > t.cut[n])
    return t


def _level(binned: DataFrame, kind: str, trees: int, tops: dict[tuple[int, int], Growing], some: dict[tuple[int, int], np.ndarray], edges: list) -> DataFrame:
    """(g, tree, node, feature, bin, c, s, q) summed over the drawn rows of ``some`` nodes."""
    names = ["g", "tree", "node", "feature", "bin", "c", "s", "q"]
    by: dict[int, list[int]] = {}
    for n, k in some:
        by.setdefault(n, []).append(k)
    tops = {k: tops[k] for k in some}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        acc: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for n, _, y, bins, drawn in _rows(batch, kind, trees) if batch.num_rows else ():
                width, size = len(edges[n]), max(len(c) for c in edges[n]) + 1
                for k in by.get(n, ()):
                    rows = np.flatnonzero(drawn[:, k])
                    slot = np.full(len(tops[n, k].left), -1)
                    slot[some[n, k]] = np.arange(len(some[n, k]))
                    of = slot[tops[n, k].at(bins[rows])]
                    rows, of = rows[of >= 0], of[of >= 0]
                    w = drawn[rows, k].astype(float)
                    key = ((of[:, None] * width + np.arange(width)) * size + bins[rows]).ravel()
                    length = len(some[n, k]) * width * size
                    s = acc.setdefault((n, k), np.zeros((3, length)))
                    for i, p in enumerate((w, w * y[rows], w * y[rows] * y[rows])):
                        s[i] += np.bincount(key, np.repeat(p, width), length)
        for (n, k), s in acc.items():
            width, size = len(edges[n]), max(len(c) for c in edges[n]) + 1
            key = np.flatnonzero(s[0])
            of, f, b = key // (width * size), key // size % width, key % size
            yield pa.RecordBatch.from_arrays([
                *(pa.array(np.full(len(key), v, np.int32)) for v in (n, k)), pa.array(some[n, k][of].astype(np.int32)),
                pa.array(f.astype(np.int32)), pa.array(b.astype(np.int32)), *(pa.array(v[key]) for v in s)], names=names)

    part = binned.mapInArrow(run, "g int, tree int, node int, feature int, bin int, c double, s double, q double")
    return part.groupBy(*names[:5]).agg(*[F.sum(c).alias(c) for c in names[5:]])


def _grow_tops(binned: DataFrame, kind: str, trees: int, sizes: list[int], edges: list, depth: int, memory_mb: float) -> dict[tuple[int, int], Growing]:
    """(group, tree) -> its nodes of more than LOCAL_ROWS drawn rows, split, and their
    children: of the groups that have such nodes."""
    tops = {(n, k): Growing(None, 0, depth) for n, size in enumerate(sizes) if size > LOCAL_ROWS and any(map(len, edges[n])) for k in range(trees)}
    front = {key: t.open for key, t in tops.items()}
    while front:
        cells, now = 0, {}
        for key, nodes in front.items():
            width, size = len(edges[key[0]]), max(len(c) for c in edges[key[0]]) + 1
            if now and cells + len(nodes) > _at_once(width, size, memory_mb):
                break
            now[key], cells = nodes, cells + len(nodes)
        sums = _level(binned, kind, trees, tops, now, edges).toArrow()
        g, k, node, f, b, *values = (sums.column(i).to_numpy() for i in range(8))
        for key, nodes in now.items():
            t, mine = tops[key], (g == key[0]) & (k == key[1])
            size = max(len(c) for c in edges[key[0]]) + 1
            table = np.zeros((3, len(nodes), len(edges[key[0]]), size))
            for i in range(3):
                table[i, np.searchsorted(nodes, node[mine]), f[mine], b[mine]] = values[i][mine]
            t.open = nodes
            t.split(*best_splits(table, np.array([len(c) for c in edges[key[0]]]), t.stats[:, nodes], t.root))
            front.pop(key)
            large = t.open[t.stats[0, t.open] > LOCAL_ROWS]
            if len(large):
                front[key] = large
    return tops


def _table(rows: list[tuple[int, int, int, dict[str, np.ndarray]]]) -> pa.Table:
    """Rows (g, tree, node, arrays)."""
    return pa.table({**{c: pa.array([r[i] for r in rows], pa.int32()) for i, c in enumerate(("g", "tree", "node"))},
                     **{c: pa.array([r[3][c].astype(d) for r in rows], pa.list_(pa.from_numpy_dtype(d))) for c, d in _ARRAYS.items()}})


def _below(binned: DataFrame, kind: str, trees: int, tops: dict[tuple[int, int], Growing], edges: list, depth: int, memory_mb: float) -> DataFrame:
    """(g, tree, node, arrays): whole trees, or what is below each small node that the tops
    leave. A node's drawn rows meet in one task."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n, at, y, bins, drawn in _rows(batch, kind, trees) if batch.num_rows else ():
                for k in range(trees):
                    some, top = np.flatnonzero(drawn[:, k]), tops.get((n, k))
                    if top is None:
                        own = {0: some}  # a tree without rows is a leaf
                    else:
                        here = top.at(bins[some])
                        own = {i: some[here == i] for i in np.unique(here).tolist() if top.stats[0, i] <= LOCAL_ROWS and top.levels[i] < depth}
                    blobs = [[a.tobytes() for a in (y[r], drawn[r, k], bins[r])] for r in own.values()]
                    yield pa.RecordBatch.from_arrays([
                        *(pa.array(np.full(len(own), v, np.int32)) for v in (n, k)), pa.array(list(own), pa.int32()), pa.array(np.full(len(own), at)),
                        *(pa.array([b[i] for b in blobs], pa.binary()) for i in range(3))], names=["g", "tree", "node", "at", "y", "drawn", "bins"])

    def below(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        n, k, node = (v.as_py() for v in key)
        t = t.sort_by("at")
        y, drawn, bins = (np.frombuffer(b"".join(t.column(c).to_pylist()), d) for c, d in (("y", "f8"), ("drawn", "u1"), ("bins", kind)))
        top = tops.get((n, k))
        at = (None, 0) if top is None else (top.stats[:, node], int(top.levels[node]))
        out = grow(y, drawn, bins.reshape(len(y), len(edges[n])), edges[n], depth, memory_mb, *at).arrays(edges[n])
        return _table([(n, k, node, pruned(out) if top is None else out)])

    part = binned.mapInArrow(rows, "g int, tree int, node int, at long, y binary, drawn binary, bins binary")
    return part.groupBy("g", "tree", "node").applyInArrow(below, PIECE_SCHEMA)


def _joined(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
    """A tree from its top (node -1) and what is below the top's leaves; or a whole one."""
    pieces = {t.column("node")[r].as_py(): {c: np.asarray(t.column(c)[r].values, d) for c, d in _ARRAYS.items()} for r in range(t.num_rows)}
    if -1 not in pieces:
        return t
    whole = {c: [a.copy()] for c, a in pieces.pop(-1).items()}
    n = len(whole["left"][0])
    for at, piece in sorted(pieces.items()):
        left = np.where(piece["left"] >= 0, piece["left"] + n - 1, -1)  # its root is the top's leaf
        for c, a in (piece | {"left": left}).items():
            whole[c][0][at] = a[0]
            whole[c].append(a[1:])
        n += len(left) - 1
    return _table([(key[0].as_py(), key[1].as_py(), 0, pruned({c: np.concatenate(a) for c, a in whole.items()}))])


def fit_groups(df: DataFrame, features, label: str, groups=(), lists: dict[tuple, list[str]] | None = None, trees: int = 300, seed: int = 42,
               memory_mb: int = 256, depth: int = 30, bootstrap: bool = True, max_bins: int = 32) -> dict[tuple, Forest]:
    """Group key (a tuple; () without groups) -> its forest, over the group's features in
    ``lists`` (default: all). A group without rows has no forest; missing values of a
    group's features or label are an error."""
    from hourcast.session import reliable_checkpoint, scratch_path
    spark, keys, features = df.sparkSession, list(groups), list(features)
    data = df.select(*keys, F.col(label).cast("double").alias("_y"), *[F.col(c).cast("double").alias(c) for c in features])
    counts = {tuple(r[k] for k in keys): r["_n"] for r in data.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).collect() if r["_n"]}
    order = sorted(counts, key=str)
    if not order:
        return {}
    number, sizes, lists = {k: i for i, k in enumerate(order)}, [counts[k] for k in order], lists or {}
    names = [list(lists.get(k, features)) for k in order]
    own = [[features.index(c) for c in some] for some in names]
    edges = _cuts(data, keys, number, sizes, own, max_bins, seed)
    kind = "u1" if max(len(c) for e in edges for c in e) < 256 else "<u4"
    binned = reliable_checkpoint(_binned(data, keys, number, own, edges, kind, trees, seed, bootstrap))
    tops = _grow_tops(binned, kind, trees, sizes, edges, depth, memory_mb)
    grown = _below(binned, kind, trees, tops, edges, depth, memory_mb)
    if tops:
        above = spark.createDataFrame(_table([(n, k, -1, t.arrays(edges[n])) for (n, k), t in tops.items()]), PIECE_SCHEMA)
        grown = grown.unionByName(above).groupBy("g", "tree").applyInArrow(_joined, PIECE_SCHEMA)
    path = scratch_path(spark, f"forest-{uuid.uuid4().hex}")
    grown.drop("node").write.partitionBy("g").parquet(path)
    stored = spark.read.schema(f"g int, {TREE_SCHEMA}").parquet(path)
    return {k: Forest(names[i], trees, stored.filter(F.col("g") == i).drop("g")) for k, i in number.items()}


def predict(df: DataFrame, model: Forest) -> DataFrame:
    """``df`` with ``prediction``. Rows are stored once and numbered; each number of rows
    meets each number of trees in a task."""
    from hourcast.session import reliable_checkpoint
    rows = reliable_checkpoint(df.withColumn("_id", F.monotonically_increasing_id()))
    buckets, chunks, width = -(-rows.count() // ROWS_AT_ONCE) or 1, -(-model.trees // TREES_AT_ONCE), len(model.features)

    def walked(key: tuple[pa.Scalar, ...], x: pa.Table, nodes: pa.Table) -> pa.Table:
        out, ids = np.zeros(x.num_rows), x.column("_id")
        values = np.column_stack([x.column(f"_x{i}").cast(pa.float64()).fill_null(float("nan")).to_numpy() for i in range(width)])
        if np.isnan(values).any():
            raise ValueError("a forest takes no missing values")
        for t in _trees(nodes):
            out += t["value"][_last(by_values(t, values))]
        return pa.table({"_id": ids, "_c": pa.array(np.full(len(out), key[0].as_py(), np.int32)), "p": pa.array(out)})

    left = rows.select("_id", (F.col("_id") % buckets).cast("int").alias("_b"), *[F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(model.features)])
    left = left.withColumn("_c", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    right = model.nodes.withColumn("_c", F.floor(F.col("tree") / TREES_AT_ONCE).cast("int")).withColumn("_b", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
    some = left.groupBy("_c", "_b").cogroup(right.groupBy("_c", "_b")).applyInArrow(walked, "_id long, _c int, p double")
    parts = F.transform(F.array_sort(F.collect_list(F.struct("_c", "p"))), lambda s: s["p"])
    means = some.groupBy("_id").agg((F.aggregate(parts, F.lit(0.0), lambda a, p: a + p) / F.lit(float(model.trees))).alias("prediction"))
    return rows.join(means, "_id").drop("_id")
