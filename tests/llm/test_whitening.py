"""Whitening against exact integers and numpy."""

import math
from fractions import Fraction

import numpy as np
import pytest

from hourcast.llm import whitening
from hourcast.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, n int, dim string, x string"


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame([(*r, 1, "d", "x") for r in rows], schema).repartition(5)


def whole(c):
    return math.floor(64 * c) + 1_000_000


def brute(rows):
    """id list, n, exact deviations, x - S/n, covariance (exact), of rows of one length."""
    xs = [(i, [whole(float(np.float32(c))) for c in e]) for i, e in rows]
    fit = sorted({tuple(x) for _, x in xs})
    n, d = len(fit), len(fit[0])
    s = [sum(x[j] for x in fit) for j in range(d)]
    cov = [[Fraction(sum((n * x[j] - s[j]) * (n * x[k] - s[k]) for x in fit), n**3) for k in range(d)] for j in range(d)]
    return n, xs, s, cov


@pytest.mark.parametrize("d,n,scales", [(5, 40, None), (20, 700, None), (3, 50, [1, 2000, 60_000])])
def test_whitening_equals_brute_force(spark, d, n, scales):
    g = np.random.default_rng(d)
    base = (g.normal(size=(n, d)) @ g.normal(size=(d, d)) / 4 * (scales or 1)).astype(np.float32)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(base)]
    rows += [(0, rows[0][1]), (n + 1, rows[0][1]), (None, rows[1][1])]
    got = frame(spark, rows)
    got = whitening.whiten(got, whitening.fit_whitening(got)).collect()
    m, xs, s, cov = brute(rows)
    assert len(got) == len(rows) * min(16, d)
    e = np.linalg.eigvalsh(np.array([[float(c) for c in r] for r in cov]))[::-1]
    z, dev = {}, {}
    for r in got:
        assert r.n == m and r.identity_error < 1e-8
        assert r.explained == pytest.approx(e[r.component - 1] / e.sum(), rel=1e-4)
        z.setdefault((r.vec_id, r.component), set()).add(r.whitened)
        dev[r.vec_id] = int(r.deviation)
    assert all(len(v) == 1 for v in z.values())
    v = np.array([[float(c) for c in r] for r in cov])
    w, vec = np.linalg.eigh(v)
    for i, x in xs:
        assert dev[i] == sum((m * a - b) ** 2 for a, b in zip(x, s))
    for k in range(min(16, d)):
        p = np.array([[float(Fraction(m * a - b, m)) for a, b in zip(x, s)] for _, x in xs]) @ vec[:, -1 - k] / np.sqrt(w[-1 - k])
        q = np.array([next(iter(z[i, k + 1])) for i, _ in xs])
        assert np.allclose(p, q, atol=1e-6) or np.allclose(p, -q, atol=1e-6)


def test_bit_planes_give_exact_products():
    g = np.random.default_rng(1)
    for n, d, top in ((1, 1, 1), (63, 4, 7), (64, 3, 1000), (1000, 6, 1 << 20), (5, 2, 1 << 60)):
        y = g.integers(0, top, (n, d), endpoint=True).astype(np.uint64)
        y[:, 0] = 0
        bits = [int(c.max()).bit_length() for c in y.T]
        counts = np.zeros((d, d, max(2 * max(bits) - 1, 1)), np.int64)
        whitening.add_products(counts, y, bits)
        for i in range(d):
            for j in range(i, d):
                assert sum(int(c) << s for s, c in enumerate(counts[i, j])) == sum(int(a) * int(b) for a, b in zip(y[:, i], y[:, j]))


def test_large_offset_and_small_eigenvalues():
    """Eigenvalues 10^14 apart keep their relative precision."""
    g = np.random.default_rng(3)
    x = np.array([[int(a), int(b) * 10**7, int(c)] for a, b, c in g.integers(-50, 50, (400, 3))], object)
    x[:, 2] += 3 * x[:, 0] + 10**15
    n, s = len(x), x.sum(0)
    c = x.T.dot(x) * n - np.outer(s, s)
    e, v, trace = whitening.eigen(c, n)
    z = np.array([[float(Fraction(n * int(a) - int(b), n)) for a, b in zip(r, s)] for r in x]) @ v / np.sqrt(e)
    assert np.abs(z.T @ z / n - np.eye(3)).max() < 1e-6
    assert trace == pytest.approx(e.sum())


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [nan, 1.0]), (4, [1.0, None]), (5, [inf, 0.0]), (6, [3.4e38, -3.4e38]), (7, [0.5, 0.25]), (7, [0.5, 0.25]),
            (8, [1.0, 1.0, 1.0]), (None, [0.5, 0.125]), (9, [2.0] * 3), (10, [1.5] * 3), (11, [0.1])]
    df = frame(spark, rows)
    got = whitening.whiten(df, whitening.fit_whitening(df)).collect()
    assert sorted((r.vec_id or 0, r.component) for r in got) == sorted(
        [(i, k) for i in (6, 7, 7, 0) for k in (1, 2)] + [(i, k) for i in (8, 9, 10) for k in (1, 2, 3)] + [(11, 1)])
    assert {r.n for r in got if r.vec_id in (8, 9, 10)} == {3}
    flat = [r for r in got if r.vec_id == 11]
    assert flat[0].whitened is None and flat[0].explained == 0 and flat[0].identity_error == 0 and int(flat[0].deviation) == 0
    assert all((r.whitened is None) == (r.component > 1) for r in got if r.vec_id in (8, 9, 10))
    x = [0 - 2**62 + 1_000_000, 2**62 + 1_000_000]
    assert [x[1], x[0]] == whitening.usable(df).filter("vec_id = 6").first().x
    empty = spark.createDataFrame([], SCHEMA)
    assert whitening.whiten(empty, whitening.fit_whitening(empty)).count() == 0


def test_registered_query(spark):
    out = QUERIES["op13_embedding_whitening"](spark, "/root/testdata/sf0.001")
    assert dict(out.dtypes)["deviation"] == "bigint" and dict(out.dtypes)["component"] == "int"
    rows = out.collect()
    source = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select("vec_id", "embedding").collect()
    n, xs, s, cov = brute([(r.vec_id, r.embedding) for r in source])
    want = {i: sum((n * a - b) ** 2 for a, b in zip(x, s)) for i, x in xs}
    assert len(rows) == 16 * len(source)
    e = np.linalg.eigvalsh(np.array([[float(c) for c in r] for r in cov]))[::-1]
    for r in rows:
        assert r.deviation == want[r.vec_id] and r.n == n and r.identity_error < 1e-9
        assert r.explained == pytest.approx(e[r.component - 1] / e.sum(), rel=1e-9)
