"""Exact top-k by inner product with a dual-tree cover-tree search.

Vectors are cut into blocks by a hash of their id; a block is one packed row.
Every block of data and every block of queries builds a cover tree; a task
searches one pair of blocks by descending both trees together.  A pair of nodes
is pruned when ``<c_q, c_x> + r_q |c_x| + r_x |c_q| + r_q r_x``, the largest inner
product any of their members can have, is below the worst k-th score of the
query node.  Queries start from the k-th score against a fixed set of data
vectors (``SEED_ROWS`` of them, real candidates, so the bound is valid), and
each task's k best per query are merged by rank.

Every pair of blocks is searched: the queries are all matched against all rows,
in blocks.  Coordinates are integers and so are the scores.

Defined results: vectors null, or holding null or non-finite components, take no
part; a vector shorter or longer than the query's is no candidate of it.  Ties
go to the smaller id; a row's own id is never its candidate.  Rows of equal id
and vector are one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

K = 10
DATA_BLOCK = 8192
QUERY_BLOCK = 16384
SEED_ROWS = 512
LEAF = 64


class Tree:
    """A cover tree over rows: nodes with a member as centre, the radius that
    covers their members, and either children or a leaf's rows."""

    def __init__(self, points: np.ndarray):
        self.points = points.astype(np.float64)
        self.square = (self.points**2).sum(1)
        self.centre: list[int] = []
        self.radius: list[float] = []
        self.rows: list[np.ndarray] = []
        self.children: list[list[int]] = []
        self.root = self._build(np.arange(len(points))) if len(points) else -1
        self.norm = np.sqrt(self.square)

    def _far(self, i: int, rows: np.ndarray) -> np.ndarray:
        d = self.square[rows] + self.square[i] - 2 * (self.points[rows] @ self.points[i])
        # Rounding must not make a radius too small.
        return np.sqrt(np.maximum(d, 0) + 1e-9 * (self.square[rows] + self.square[i]) + 1e-9)

    def _node(self, rows: np.ndarray, far: np.ndarray) -> int:
        self.centre.append(int(rows[0]))
        self.radius.append(float(far.max()))
        self.rows.append(rows)
        self.children.append([])
        return len(self.centre) - 1

    def _build(self, rows: np.ndarray) -> int:
        top = self._node(rows, self._far(rows[0], rows))
        todo = [top]
        while todo:
            node = todo.pop()
            rows = self.rows[node]
            if len(rows) <= LEAF or self.radius[node] <= 1e-3:
                continue
            cover, left, groups = self.radius[node] / 2, rows, []
            while len(left) and len(groups) <= len(rows) // LEAF + 8:
                far = self._far(left[0], left)
                near = far <= cover
                near[0] = True
                groups.append((left[near], far[near]))
                left = left[~near]
            if len(left) or len(groups) < 2:
                # Too scattered for that radius: halves about two far members.
                a = rows[self._far(rows[0], rows).argmax()]
                b = rows[self._far(a, rows).argmax()]
                closer = self._far(a, rows) <= self._far(b, rows)
                parts = [rows[closer], rows[~closer]]
                if not all(map(len, parts)):
                    continue
                groups = []
                for c, part in zip((a, b), parts):
                    part = np.concatenate(([c], part[part != c]))
                    groups.append((part, self._far(c, part)))
            for part, far in groups:
                child = self._node(part, far)
                self.children[node].append(child)
                todo.append(child)
        return top


def search(qid: np.ndarray, q: np.ndarray, xid: np.ndarray, x: np.ndarray, k: int, floor: np.ndarray
           ) -> tuple[np.ndarray, np.ndarray]:
    """(ids, scores), k columns, best first (id -1: none): the k best rows of x for
    each query, by descending score and ascending id.  ``floor`` is a valid lower
    bound of each query's k-th score; rows below it may be left out."""
    ids = np.full((len(q), k), np.iinfo(np.int64).max)
    scores = np.full((len(q), k), np.iinfo(np.int64).min)
    if not len(q) or not len(x):
        return np.full((len(q), k), -1), scores
    big = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * q.shape[1]
    exact = (lambda a, b: (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)) if big < 2**53 else (lambda a, b: a @ b.T)
    tq, tx = Tree(q), Tree(x)
    worst = floor.astype(np.float64)

    def merge(rows: np.ndarray, cols: np.ndarray) -> None:
        s = exact(q[rows], x[cols])
        s[qid[rows][:, None] == xid[cols][None, :]] = np.iinfo(np.int64).min
        keep = np.flatnonzero((s >= np.maximum(scores[rows, -1], worst[rows].clip(-9e18, 9e18).astype(np.int64))[:, None]).any(1))
        for r in keep:
            i = rows[r]
            good = np.flatnonzero((s[r] >= max(scores[i, -1], int(max(worst[i], -9e18)))) & (s[r] > np.iinfo(np.int64).min))
            if not len(good):
                continue
            ci, cs = np.concatenate((ids[i], xid[cols[good]])), np.concatenate((scores[i], s[r][good]))
            order = np.lexsort((ci, ~cs))[:k]
            ids[i], scores[i] = ci[order], cs[order]
            worst[i] = max(worst[i], float(scores[i, -1]))

    stack = [(tq.root, tx.root)]
    while stack:
        a, b = stack.pop()
        ca, cb = tq.centre[a], tx.centre[b]
        ra, rb = tq.radius[a], tx.radius[b]
        most = float(tq.points[ca] @ tx.points[cb]) + ra * tx.norm[cb] + rb * tq.norm[ca] + ra * rb
        if most * (1 + 1e-9 * np.sign(most)) + 1e-6 < worst[tq.rows[a]].min():
            continue
        split_x = tx.children[b] and (not tq.children[a] or rb >= ra)
        if split_x:
            # The most promising child is searched first (the stack's end).
            bound = [float(tq.points[ca] @ tx.points[tx.centre[c]]) + ra * tx.norm[tx.centre[c]] + tx.radius[c] * (tq.norm[ca] + ra)
                     for c in tx.children[b]]
            stack += [(a, tx.children[b][j]) for j in np.argsort(bound)]
        elif tq.children[a]:
            stack += [(c, b) for c in tq.children[a]]
        else:
            merge(tq.rows[a], tx.rows[b])
    none = scores == np.iinfo(np.int64).min
    return np.where(none, -1, ids), scores


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(id, dim, v): integer coordinates floor(1024 x) of the vectors that take part."""
    e = F.transform(F.col(embedding), lambda y: y.cast("double"))
    good = F.col(embedding).isNotNull() & F.col(vec_id).isNotNull() & F.forall(
        e, lambda y: y.isNotNull() & ~F.isnan(y) & (F.abs(y) != float("inf")))
    v = vectors.filter(good).select(F.col(vec_id).cast("long").alias("id"), F.transform(e, lambda y: F.floor(y * 1024)).alias("v"))
    return v.distinct().withColumn("dim", F.size("v"))


def block_count(v: DataFrame, rows: int) -> int:
    return max(1, -(-v.count() // rows))


def blocks(v: DataFrame, rows: int, name: str) -> DataFrame:
    """One row per block: dim, block, ids, vectors (packed arrays)."""
    n = block_count(v, rows)
    g = v.withColumn("block", F.pmod(F.xxhash64(F.lit(name), "id"), F.lit(n)).cast("int"))
    return g.groupBy("dim", "block").agg(F.collect_list("id").alias("ids"), F.flatten(F.collect_list("v")).alias("flat"))


def top_k(vectors: DataFrame, queries, k: int = K, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score of each query's k best; ``queries`` is a
    condition on the column ``id``."""
    v = materialise(usable(vectors, vec_id, embedding), "topk-vectors")
    ask = materialise(v.filter(queries), "topk-queries")
    n_x, n_q = block_count(v, DATA_BLOCK), block_count(ask, QUERY_BLOCK)
    # Both sides carry the pair's two block numbers: a join key has one row on each side.
    data = blocks(v, DATA_BLOCK, "data").select("dim", F.col("block").alias("xb"), F.col("ids").alias("xid"), F.col("flat").alias("x"),
                                                F.explode(F.sequence(F.lit(0), F.lit(n_q - 1))).alias("qb"))
    asked = blocks(ask, QUERY_BLOCK, "query").select("dim", F.col("block").alias("qb"), F.col("ids").alias("qid"), F.col("flat").alias("q"),
                                                     F.explode(F.sequence(F.lit(0), F.lit(n_x - 1))).alias("xb"))
    first = v.withColumn("_o", F.xxhash64(F.lit("seed"), "id")).orderBy("_o", "id").limit(SEED_ROWS)
    seeds = first.groupBy("dim").agg(F.collect_list("id").alias("sid"), F.flatten(F.collect_list("v")).alias("s"))
    pairs = asked.join(data, ["dim", "qb", "xb"]).join(F.broadcast(seeds), "dim", "left")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for r in b.itertuples(index=False):
                dim = max(int(r.dim), 1)
                q, x = (np.asarray(c, np.int64).reshape(-1, dim) if r.dim else np.zeros((n, 1), np.int64)
                        for c, n in ((r.q, len(r.qid)), (r.x, len(r.xid))))
                qid, xid = np.asarray(r.qid, np.int64), np.asarray(r.xid, np.int64)
                floor = np.full(len(qid), -np.inf)
                if r.sid is not None and r.dim and len(r.sid) > k:
                    s = q @ np.asarray(r.s, np.int64).reshape(-1, dim).T
                    s[qid[:, None] == np.asarray(r.sid, np.int64)[None, :]] = np.iinfo(np.int64).min
                    floor = np.partition(s, -k, axis=1)[:, -k].astype(np.float64)
                ids, scores = search(qid, q, xid, x, k, floor)
                row, col = np.nonzero(scores > np.iinfo(np.int64).min)
                yield pd.DataFrame({"query_id": qid[row], "vec_id": ids[row, col], "score": scores[row, col]})

    found = pairs.mapInPandas(run, "query_id long, vec_id long, score long").distinct()
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
