"""Boosted trees, node tables and path contributions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from hourcast.operators import boosting as B
from hourcast.operators import contributions as C

NAMES = ["a", "b", "c"]


def data(n=400, seed=0, missing=True):
    g = np.random.default_rng(seed)
    x = g.normal(size=(n, 3))
    y = 3 * x[:, 0] + np.where(x[:, 1] > 0.3, 5, 0) + 0.1 * g.normal(size=n)
    rows = [(int(i % 2), *[None if missing and g.random() < 0.1 else float(v) for v in r], float(t)) for i, (r, t) in enumerate(zip(x, y))]
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "grp int, a double, b double, c double, y double").repartition(5)


def brute_tree(x, grad, depth, step, cuts):
    """A tree as nested tuples by trying every cut: (feature, cut value, missing left, left, right) or value."""
    g, h = grad.sum(), float(len(grad))
    value = -step * g / (h + 1)
    if not depth:
        return value
    options = []
    for missing_left in (True, False):
        for j in range(x.shape[1]):
            for c in cuts[j]:
                left = np.where(np.isnan(x[:, j]), missing_left, x[:, j] <= c)
                gl, hl = grad[left].sum(), float(left.sum())
                if hl >= 1 and h - hl >= 1:
                    gain = gl * gl / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g * g / (h + 1)
                    options.append((round(-gain, 8), not missing_left, j, c, left))
    options = [o for o in options if -o[0] > 1e-6]
    if not options:
        return value
    _, right_first, j, c, left = min(options, key=lambda o: o[:4])
    return (j, c, not right_first, brute_tree(x[left], grad[left], depth - 1, step, cuts),
            brute_tree(x[~left], grad[~left], depth - 1, step, cuts))


def brute_predict(tree, r):
    while isinstance(tree, tuple):
        j, c, missing_left, a, b = tree
        tree = a if (missing_left if np.isnan(r[j]) else r[j] <= c) else b
    return tree


def test_boosting_equals_brute_force(spark):
    """Two groups, missing values, three rounds of depth 3, margins rewritten between."""
    rows = data(260)
    old, B.REFRESH = B.REFRESH, 2
    try:
        models = B.fit_groups(frame(spark, rows), NAMES, "y", ["grp"], rounds=3, step=0.3, depth=3, bins=8)
    finally:
        B.REFRESH = old
    edges = B.bin_edges(frame(spark, rows).withColumnRenamed("y", "_y"), NAMES, ["grp"], 8)
    got = B.predict_groups(frame(spark, rows), models, ["grp"]).collect()
    for k in (0, 1):
        mine = [r for r in rows if r[0] == k]
        x = np.array([[np.nan if v is None else v for v in r[1:4]] for r in mine])
        y = np.array([r[4] for r in mine])
        # One more cut than edges: all values left, missing right.
        cuts = [[*e, np.inf] for e in edges[k,][0]]
        margin = np.full(len(y), y.mean())
        for _ in range(3):
            tree = brute_tree(x, margin - y, 3, 0.3, cuts)
            margin += [brute_predict(tree, r) for r in x]
        want = {tuple(r): m for r, m in zip(mine, margin)}
        for r in got:
            if r.grp == k:
                assert r.prediction == pytest.approx(want[tuple(r)[:5]], abs=1e-9)


def test_rounds_lower_the_loss(spark):
    df = frame(spark, data(1000, 3, False))
    losses = []
    for rounds in (1, 5, 20):
        p = B.predict_groups(df, B.fit_groups(df, NAMES, "y", rounds=rounds, step=0.3, depth=4))
        losses.append(p.agg(F.avg((F.col("y") - F.col("prediction")) ** 2)).first()[0])
    assert losses[0] > 2 * losses[1] > 4 * losses[2]


def test_driver_sees_sums_only(spark):
    """The level's job returns sums by (group, node, feature, bin), partially aggregated."""
    df = frame(spark, data(500))
    models = B.fit_groups(df, NAMES, "y", ["grp"], rounds=1, depth=1, bins=4)
    assert {k for k in models} == {(0,), (1,)}
    found = B.bin_edges(df.withColumnRenamed("y", "_y"), NAMES, ["grp"], 4)
    order = sorted(found, key=str)
    binned = B._binned(df.withColumnRenamed("y", "_y"), NAMES, {k: i for i, k in enumerate(order)}, [found[k] for k in order], ["grp"])
    t = B.Tree()
    t.add(0.0, 1.0)
    hist = B._histogram(binned, 3, {}, {0: (t.arrays(), [0]), 1: (t.arrays(), [0])})
    assert hist.count() <= 2 * 3 * 5
    assert hist.agg(F.sum("hess")).first()[0] == 500 * 3


@pytest.mark.parametrize("rows", [
    [(0, 1.0, None, None, 2.0)], [(0, 1.0, 2.0, 3.0, None)], [], [(0, None, None, None, float(i)) for i in range(5)],
    [(0, float("nan"), 1.0, 1.0, 1.0), (0, 2.0, 1.0, 1.0, 9.0), (None, 1.0, 1.0, 1.0, 3.0)],
])
def test_degenerate_inputs(spark, rows):
    df = spark.createDataFrame(rows, "grp int, a double, b double, c double, y double")
    models = B.fit_groups(df, NAMES, "y", ["grp"], rounds=2, depth=2)
    labelled = [r for r in rows if r[4] is not None]
    assert set(models) == {(r[0],) for r in labelled}
    p = B.predict_groups(df, models, ["grp"]).collect()
    assert len(p) == len(rows) and all((r.prediction is None) == ((r.grp,) not in models) for r in p)


def test_node_table_round_trip(spark):
    df = frame(spark, data())
    model = B.fit_groups(df, NAMES, "y", rounds=4, depth=3)[()]
    back = B.from_nodes(B.nodes_frame(spark, model).collect(), NAMES, model.base)
    a, b = (sorted(tuple(r) for r in B.predict_groups(df.na.fill(0.0), {(): m}).select("a", "prediction").collect()) for m in (model, back))
    assert a == b
    assert sum(model.importances()) == pytest.approx(1) and model.importances()[2] < 0.05
    root = B.nodes_frame(spark, model).filter("tree = 0 and node = 0").first()
    assert root.cover == 400


def test_contributions_add_up_for_boosted_and_forest(spark):
    from hourcast.operators import ml as ML
    df = frame(spark, data(300, 5, False)).withColumn("series", F.concat(F.lit("s"), "grp"))
    model = B.fit_groups(df, NAMES, "y", rounds=5, depth=3)[()]
    for r in C.path_contributions(df, model).join(B.predict_groups(df, {(): model}).select("a", F.col("prediction").alias("p")), "a").collect():
        assert r.base + sum(r.contributions) == pytest.approx(r.p, abs=1e-9)
    forest = ML.fit_forest(df, NAMES, "y", trees=5)
    table = C.ensemble(C.forest_nodes(forest, NAMES), NAMES)
    assert len(table.trees) == 5
    want = {r.a: r.prediction for r in ML.predict(forest, df, NAMES).collect()}
    for r in C.path_contributions(df, table).collect():
        assert r.base + sum(r.contributions) == pytest.approx(want[r.a], abs=1e-9) and r.prediction == pytest.approx(want[r.a], abs=1e-9)
    imp = {(r.series, r.feature): r.importance for r in C.tree_importance(df, table).collect()}
    assert len(imp) == 6 and imp["s0", "a"] > imp["s0", "b"] > imp["s0", "c"]
    # One path by hand.
    one = df.limit(1).collect()[0]
    got = C.path_contributions(df.filter(F.col("a") == one.a), table).first()
    want = np.zeros(3)
    for t in table.trees:
        at = 0
        while t["left"][at] >= 0:
            f = t["feature"][at]
            to = t["left"][at] if one[NAMES[f]] <= t["threshold"][at] else t["right"][at]
            want[f] += t["value"][to] - t["value"][at]
            at = to
    assert list(got.contributions) == pytest.approx(list(want), abs=1e-12)


def test_ridge_from_moments(spark):
    """Equal to the closed form per group, with a large offset, and to Spark ML's solver."""
    from hourcast.operators import linear as L
    from hourcast.operators import ml as ML
    rows = [(k, a + 1e7, b, c, y) for k, a, b, c, y in data(300, 9, False)]
    df = frame(spark, rows)
    found = L.moments(df, NAMES, "y", ["grp"])
    for k in (0, 1):
        x = np.array([r[1:4] for r in rows if r[0] == k])
        y = np.array([r[4] for r in rows if r[0] == k])
        xc, yc = x - x.mean(0), y - y.mean()
        for pick in ([0, 1, 2], [2, 1]):
            m = L.ridge(found[k,], [NAMES[i] for i in pick], 1.0)
            w = np.linalg.solve(xc[:, pick].T @ xc[:, pick] + np.eye(len(pick)), xc[:, pick].T @ yc)
            assert m.coefficients == pytest.approx(list(w), rel=1e-6)
            p = df.filter(f"grp = {k}").select("y", m.column().alias("p")).collect()
            assert np.mean([r.p for r in p]) == pytest.approx(y.mean(), rel=1e-6)
    small = frame(spark, data(200, 4, False)).select(*NAMES, "y")
    spark_model = ML.fit_ridge(small, NAMES, "y")
    own = L.ridge(L.moments(small, NAMES, "y")[()])
    assert own.coefficients == pytest.approx(list(spark_model.coefficients), rel=1e-6)
    assert own.intercept == pytest.approx(spark_model.intercept, rel=1e-6)
    assert L.moments(small.limit(0), NAMES, "y") == {}
