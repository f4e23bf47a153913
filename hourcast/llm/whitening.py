"""Whitening of embeddings from exact, bit-sliced cross-products.

Coordinates become integers, ``floor(SCALE * c) + OFFSET``.  The fit list holds each
distinct vector once.  Its statistics take two passes:

1. least and largest value, sum and count of each dimension;
2. the scatter: each dimension is shifted by its least value, bit ``a`` of dimension
   ``i`` is packed across rows into 64-bit words, and the popcount of the AND of the
   planes ``(i, a)`` and ``(j, b)``, weighted by ``2^(a + b)``, adds up to the exact
   sum of products.  A task emits one row per pair of dimensions (its counts by
   ``a + b``), which Spark adds up.

The driver centres the sums as integers (``n * Q - T T'``, no rounding whatever the
offset) and takes ``eigh`` of the covariance; what it holds is the square of the
dimension, never rows.  Cyclic Jacobi rotations in extended precision then mend what
``eigh`` leaves between eigenvalues far below the largest.  Rows are whitened where
they lie: no row is shuffled but for the distinct fit list.

Defined results: vectors that are null, empty, or hold null or non-finite entries
have no row.  Vectors of different lengths are fitted and whitened apart, each length
as a fit of its own.  Scaled entries beyond 2^62 are held there.  Repeated rows give
repeated rows; a null id stays null.  A component whose eigenvalue is zero (the fit
list is constant along it, or has one vector) has a null ``whitened`` and takes no
part in ``identity_error``.  ``deviation`` is null beyond 38 digits.  An empty table
gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 16
LARGEST = 1 << 62
ZERO = 1e-17       # eigenvalues up to this share of the trace, times the dimension, are zero
CLEAN = 1e-14      # off-diagonal entries below this share of their diagonal's mean are zero


@dataclass
class Whitener:
    """Fit of the vectors of one length."""
    n: int
    least: np.ndarray            # int64: each dimension's shift
    spread: list[int]            # each dimension's largest shifted value
    total: list[int]             # sums of the shifted values
    values: np.ndarray           # eigenvalues, falling
    vectors: np.ndarray          # unit eigenvectors, columns in the same order
    trace: float
    identity_error: float = 0.0

    def kept(self, components: int) -> np.ndarray:
        """Whether each of the first components has an eigenvalue above zero."""
        return self.values[:components] > ZERO * len(self.values) * self.trace


def usable(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, x): integer coordinates of the vectors that take part."""
    e = F.transform(F.col(embedding), lambda y: y.cast("double"))
    good = F.col(embedding).isNotNull() & (F.size(embedding) > 0) & F.forall(
        e, lambda y: y.isNotNull() & ~F.isnan(y) & (F.abs(y) != float("inf")))

    def whole(y):
        return F.least(F.greatest(F.floor(y * SCALE), F.lit(-LARGEST)), F.lit(LARGEST)) + F.lit(OFFSET)

    return vectors.filter(good).select(F.col(vec_id).cast("long").alias("vec_id"), F.transform(e, whole).alias("x"))


def matrices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, their vectors) for each length in a column of lists."""
    sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    for d in np.unique(sizes):
        rows = np.flatnonzero(sizes == d)
        yield rows, flat.reshape(-1, d) if len(rows) == len(sizes) else flat[(ends[rows] - d)[:, None] + np.arange(d)]


def dimension_stats(fit: DataFrame) -> dict[int, dict]:
    """Length -> n, least, most and sum of each dimension."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, list] = {}
        for batch in batches:
            for _, m in matrices(batch.column(0)):
                # Sums in two halves: neither can overflow.
                now = [m.min(0), m.max(0), (m >> 32).sum(0), (m & 0xFFFFFFFF).sum(0)]
                n, old = seen.get(m.shape[1], (0, None))
                if old:
                    now = [np.minimum(old[0], now[0]), np.maximum(old[1], now[1]), old[2] + now[2], old[3] + now[3]]
                seen[m.shape[1]] = (n + len(m), now)
        for d, (n, parts) in seen.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(d, d), pa.int32()), pa.array(np.arange(d), pa.int32()),
                                              pa.array(np.full(d, n)), *map(pa.array, parts)], names=names)

    names = ["dim", "i", "n", "least", "most", "high", "low"]
    part = fit.select("x").mapInArrow(run, "dim int, i int, n long, least long, most long, high long, low long")
    whole = part.groupBy("dim", "i").agg(F.sum("n").alias("n"), F.min("least").alias("least"), F.max("most").alias("most"),
                                         F.sum(F.col("high").cast("decimal(38,0)")).alias("high"),
                                         F.sum(F.col("low").cast("decimal(38,0)")).alias("low"))
    out: dict[int, dict] = {}
    for r in sorted(whole.collect(), key=lambda r: (r.dim, r.i)):
        s = out.setdefault(r.dim, {"n": r.n, "least": [], "most": [], "sum": []})
        s["least"].append(r.least)
        s["most"].append(r.most)
        s["sum"].append((int(r.high) << 32) + int(r.low))
    return out


def planes(y: np.ndarray, bits: list[int]) -> np.ndarray:
    """Bit planes of the shifted columns, dimension by dimension and lowest bit first,
    each packed across the rows into uint64 words."""
    pad = np.zeros((-(-len(y) // 64) * 64, sum(bits)), np.uint8)
    k = 0
    for i, width in enumerate(bits):
        shifts = np.arange(width, dtype=np.uint64)
        pad[:len(y), k:k + width] = (y[:, i, None] >> shifts) & np.uint64(1)
        k += width
    return np.packbits(np.ascontiguousarray(pad.T), axis=1).view(np.uint64)


def add_products(counts: np.ndarray, y: np.ndarray, bits: list[int]) -> None:
    """Add to ``counts[i, j, a + b]`` (i <= j) how many rows have bit a of y_i and bit b of y_j."""
    words = planes(y, bits)
    of = np.repeat(np.arange(len(bits)), bits)
    at = np.concatenate([np.arange(w) for w in bits]) if len(of) else of
    first = np.searchsorted(of, of)
    for k in range(len(of)):
        both = np.bitwise_count(words[first[k]:] & words[k]).sum(1, dtype=np.int64)
        counts[of[k], of[first[k]:], at[k] + at[first[k]:]] += both


def scatter(fit: DataFrame, stats: dict[int, dict]) -> dict[int, np.ndarray]:
    """Length -> matrix (Python integers) of the sums of products of the shifted vectors."""
    shift = {d: (np.array(s["least"], np.int64), [(b - a).bit_length() for a, b in zip(s["least"], s["most"])]) for d, s in stats.items()}
    weights = max([2 * max(bits) - 1 for _, bits in shift.values()] + [1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, m in matrices(batch.column(0)):
                d = m.shape[1]
                least, bits = shift[d]
                if d not in counts:
                    counts[d] = np.zeros((d, d, max(2 * max(bits) - 1, 1)), np.int64)
                add_products(counts[d], m.view(np.uint64) - least.view(np.uint64), bits)
        for d, c in counts.items():
            i, j = np.triu_indices(d)
            each = pa.FixedSizeListArray.from_arrays(pa.array(c[i, j].ravel()), c.shape[2]).cast(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), d), pa.int32()), pa.array(i, pa.int32()), pa.array(j, pa.int32()), each],
                                             names=["dim", "i", "j", "counts"])

    part = fit.select("x").mapInArrow(run, "dim int, i int, j int, counts array<long>")
    whole = part.groupBy("dim", "i", "j").agg(F.array(*[F.sum(F.get("counts", F.lit(s))) for s in range(weights)]).alias("counts"))
    out = {d: np.zeros((d, d), object) for d in stats}
    for r in whole.collect():
        out[r.dim][r.i, r.j] = out[r.dim][r.j, r.i] = sum((c or 0) << s for s, c in enumerate(r.counts))
    return out


def eigen(c: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, float]:
    """(eigenvalues, falling; unit eigenvectors as columns; trace) of c / n^2, where c
    holds exact integers.  Each eigenvector's largest entry is positive."""
    v = np.array([[np.longdouble(x) for x in row] for row in c], np.longdouble) / np.longdouble(n) / np.longdouble(n)
    x = np.linalg.eigh(v.astype(np.float64))[1].astype(np.longdouble)
    x = x @ (3 * np.eye(len(v), dtype=np.longdouble) - x.T @ x) / 2
    s = x.T @ v @ x
    for _ in range(30):
        scale = np.sqrt(np.maximum(np.diag(s), 0))
        off = np.triu(np.abs(s) > CLEAN * np.outer(scale, scale) + ZERO * ZERO * np.trace(s), 1)
        if not off.any():
            break
        for i, j in np.argwhere(off):
            if s[i, j] == 0:
                continue
            # The rotation that makes s[i, j] zero.
            tau = (s[j, j] - s[i, i]) / (2 * s[i, j])
            t = (1 if tau >= 0 else -1) / (np.abs(tau) + np.sqrt(1 + tau * tau))
            cos = 1 / np.sqrt(1 + t * t)
            turn = np.array([[cos, t * cos], [-t * cos, cos]], np.longdouble)
            s[:, [i, j]] = s[:, [i, j]] @ turn
            s[[i, j]] = turn.T @ s[[i, j]]
            x[:, [i, j]] = x[:, [i, j]] @ turn
    order = np.argsort(-np.diag(s), kind="stable")
    x = x[:, order]
    x = x * np.where(x[np.abs(x).argmax(0), np.arange(len(x))] < 0, -1, 1)
    return np.maximum(np.diag(s)[order], 0).astype(np.float64), x.astype(np.float64), float(np.trace(v))


def centred(m: np.ndarray, model: Whitener) -> tuple[np.ndarray, list]:
    """(x - S/n as doubles, exact sums of (n x - S)^2)."""
    y = m.view(np.uint64) - model.least.view(np.uint64)
    if sum((model.n * s) ** 2 for s in model.spread) < 1 << 63:
        r = y.astype(np.int64) * model.n - np.array(model.total, np.int64)
        return r / model.n, (r * r).sum(1).tolist()
    r = y.astype(object) * model.n - np.array(model.total, object)
    return (r / model.n).astype(np.float64), (r * r).sum(1).tolist()


def projector(model: Whitener, components: int) -> np.ndarray:
    """Columns v / sqrt(e) of the components; those of eigenvalue zero are NaN."""
    kept = model.kept(components)
    return model.vectors[:, :components] / np.where(kept, np.sqrt(np.where(kept, model.values[:components], 1)), np.nan)


def identity_errors(fit: DataFrame, models: dict[int, Whitener], components: int) -> dict[int, float]:
    """Length -> largest absolute entry of the whitened fit list's covariance minus the
    identity, from the whitened values themselves, in two passes (mean, then products)."""
    def sums(means: dict[int, np.ndarray] | None) -> dict[int, np.ndarray]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            acc: dict[int, np.ndarray] = {}
            for batch in batches:
                for _, m in matrices(batch.column(0)):
                    d = m.shape[1]
                    z = (centred(m, models[d])[0] @ projector(models[d], components))[:, models[d].kept(components)]
                    now = z.sum(0) if means is None else ((z - means[d]).T @ (z - means[d])).ravel()
                    acc[d] = acc.get(d, 0) + now
            for d, a in acc.items():
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(a), d), pa.int32()), pa.array(np.arange(len(a)), pa.int32()), pa.array(a)],
                                                 names=["dim", "i", "s"])

        out = {d: np.zeros(0) for d in models}
        whole = fit.select("x").mapInArrow(run, "dim int, i int, s double").groupBy("dim", "i").agg(F.sum("s").alias("s"))
        for r in sorted(whole.collect(), key=lambda r: (r.dim, r.i)):
            out[r.dim] = np.append(out[r.dim], r.s / models[r.dim].n)
        return out

    out = {}
    for d, cov in sums(sums(None)).items():
        k = int(np.sqrt(len(cov)))
        out[d] = float(np.abs(cov.reshape(k, k) - np.eye(k)).max(initial=0))
    return out


def fit_whitening(vectors: DataFrame, components: int = COMPONENTS, vec_id: str = "vec_id", embedding: str = "embedding") -> dict[int, Whitener]:
    """Length of vectors -> their fit, from each distinct vector once."""
    fit = materialise(usable(vectors, vec_id, embedding).select("x").distinct(), "whitening-fit")
    stats = dimension_stats(fit)
    products = scatter(fit, stats) if stats else {}
    models = {}
    for d, s in stats.items():
        n, least = s["n"], s["least"]
        total = [t - n * a for t, a in zip(s["sum"], least)]
        c = products[d] * n - np.outer(np.array(total, object), np.array(total, object))
        e, x, trace = eigen(c, n)
        models[d] = Whitener(n, np.array(least, np.int64), [b - a for a, b in zip(least, s["most"])], total, e, x, trace)
    if models:
        for d, error in identity_errors(fit, models, components).items():
            models[d].identity_error = error
    return models


def whiten(vectors: DataFrame, models: dict[int, Whitener], components: int = COMPONENTS, vec_id: str = "vec_id",
           embedding: str = "embedding") -> DataFrame:
    """vec_id, component (from 1), n, deviation decimal(38,0), whitened, explained,
    identity_error for each vector of a length that ``models`` has."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, m in matrices(batch.column(1)):
                model = models.get(m.shape[1])
                if model is None:
                    continue
                y, deviation = centred(m, model)
                z = y @ projector(model, components)
                k = z.shape[1]
                share = model.values[:k] / model.trace if model.trace else np.zeros(k)

                def lists(a: np.ndarray) -> pa.Array:
                    flat = pa.array(a.ravel(), pa.float64(), mask=np.isnan(a.ravel()))
                    return pa.FixedSizeListArray.from_arrays(flat, k).cast(pa.list_(pa.float64()))

                size = len(rows)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array(rows)), pa.array(np.full(size, model.n)),
                    pa.array([Decimal(v) if v < 10**38 else None for v in deviation], pa.decimal128(38, 0)),
                    lists(z), lists(np.tile(share, (size, 1))), pa.array(np.full(size, model.identity_error))],
                    names=["vec_id", "n", "deviation", "z", "share", "identity_error"])

    out = usable(vectors, vec_id, embedding).mapInArrow(
        run, "vec_id long, n long, deviation decimal(38,0), z array<double>, share array<double>, identity_error double")
    each = out.select("vec_id", "n", "deviation", "identity_error", F.posexplode(F.arrays_zip("z", "share")).alias("k", "c"))
    return each.select("vec_id", (F.col("k") + 1).cast("int").alias("component"), "n", "deviation", F.col("c.z").alias("whitened"),
                       F.col("c.share").alias("explained"), "identity_error")
