"""Forests against Spark ML's, tree by tree; groups, large nodes, prediction and registry."""

import json

import numpy as np
import pytest
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from hourcast.operators import contributions as C
from hourcast.operators import forest as R
from hourcast.operators import ml as ML

NAMES = ["a", "b", "c"]


def data(n=700, seed=0):
    """Values with ties, a column that says the same as another, equal rows."""
    g = np.random.default_rng(seed)
    a = g.normal(size=n).round(2)
    b = g.integers(0, 40, n) / 4.0
    y = (3 * a + np.where(b > 4, 5, 0) + g.normal(size=n)).round(3)
    rows = [(int(i % 2), float(u), float(v), float(-u * 2), float(t)) for i, (u, v, t) in enumerate(zip(a, b, y))]
    return rows + rows[:20]


def frame(spark, rows, parts=1):
    return spark.createDataFrame(rows, "grp int, a double, b double, c double, y double").coalesce(parts).checkpoint()


def spark_forest(df, trees, bootstrap=True, depth=30, names=NAMES):
    rf = RandomForestRegressor(labelCol="y", numTrees=trees, seed=42, featureSubsetStrategy="all", maxDepth=depth, bootstrap=bootstrap)
    return rf.fit(ML.assembler(names).transform(df))


def nested(table, tree, node=0):
    """(feature, threshold, left, right) or (value, cover) of a node table's tree."""
    r = table[tree, node]
    if r.left is None:
        return round(r.value, 9), r.cover
    return r.feature, r.threshold, nested(table, tree, r.left), nested(table, tree, r.right)


def trees(model, names, n):
    table = {(r.tree, r.node): r for r in C.forest_nodes(model, names).collect()}
    return [nested(table, k) for k in range(n)]


@pytest.mark.parametrize("bootstrap", [True, False])
def test_same_trees_as_spark_ml(spark, bootstrap):
    df = frame(spark, data())
    got = ML.fit_forest(df, NAMES, "y", trees=7, bootstrap=bootstrap, memory_mb=1)
    want = spark_forest(df, 7, bootstrap)
    own, theirs = trees(got, NAMES, 7), trees(want, NAMES, 7)
    # Spark counts a row in a leaf as often as it was drawn, like here.
    assert own == theirs
    a, b = (sorted(r.prediction for r in ML.predict(m, df, NAMES).collect()) for m in (got, want))
    assert a == pytest.approx(b, abs=1e-12)
    assert ML.normalised_importances(got, NAMES) == pytest.approx(ML.normalised_importances(want, NAMES), abs=1e-9)


def test_groups_have_their_own_features_and_draws(spark):
    """All groups at once: the trees of each group's fit alone, over several partitions."""
    df = frame(spark, data(600, 3)).withColumn("c", F.when(F.col("grp") == 0, F.col("c")))
    df = df.unionByName(df.filter("grp = 1").withColumn("a", F.col("a") + 1)).checkpoint()
    lists = {(0,): NAMES, (1,): ["b", "a"]}
    got = ML.fit_forests(df, NAMES, "y", ["grp"], lists, trees=5)
    assert set(got) == {(0,), (1,)}
    for k, names in lists.items():
        mine = df.filter(F.col("grp") == k[0])
        want = spark_forest(mine, 5, names=names)
        assert got[k].features == names and trees(got[k], names, 5) == trees(want, names, 5)


def test_large_nodes_are_split_by_jobs(spark, monkeypatch):
    """Nodes of many rows are split over their sums, small ones in one task: the same trees
    as in one task alone (labels whose sums are exact)."""
    rows = [(*r[:4], float(round(r[4]))) for r in data(900, 5)]
    df = frame(spark, rows, 3)
    want = {k: trees(m, NAMES, 4) for k, m in ML.fit_forests(df, NAMES, "y", ["grp"], trees=4).items()}
    monkeypatch.setattr(R, "LOCAL_ROWS", 60)
    large = max(c for t in want[0,] for c in [_rows(t)])
    assert large > 4 * R.LOCAL_ROWS
    for memory in (1, 256):
        got = ML.fit_forests(df, NAMES, "y", ["grp"], trees=4, memory_mb=memory)
        assert {k: trees(m, NAMES, 4) for k, m in got.items()} == want


def _rows(t):
    return t[1] if len(t) == 2 else _rows(t[2]) + _rows(t[3])


def test_rows_of_a_large_group_without_a_split_stay_apart(spark, monkeypatch):
    monkeypatch.setattr(R, "LOCAL_ROWS", 10)
    df = spark.createDataFrame([(1.0, float(i % 3), 7.0) for i in range(60)] + [(2.0, 1.0, 7.0)] * 60, "a double, b double, y double")
    model = ML.fit_forest(df, ["a", "b"], "y", trees=3, bootstrap=False)
    assert [(t["left"].tolist(), t["value"].tolist()) for r in model.nodes.toArrow().to_batches() for t in R._trees(r)] == [([-1], [7.0])] * 3
    monkeypatch.setattr(R, "CUT_ROWS", 40)
    cut = ML.fit_forest(df.withColumn("y", F.col("a")), ["a", "b"], "y", trees=1, bootstrap=False)
    assert [r.prediction - r.a for r in ML.predict(cut, df, ["a", "b"]).collect()] == [0.0] * 120


@pytest.mark.parametrize("rows", [[(1.0, 2.0, 3.0)], [(1.0, 2.0, 3.0), (2.0, 2.0, 5.0)], [(1.0, 1.0, float(i)) for i in range(4)]])
def test_few_rows_and_no_cuts(spark, rows):
    df = spark.createDataFrame(rows, "a double, b double, y double").coalesce(1).checkpoint()
    got, want = ML.fit_forest(df, ["a", "b"], "y", trees=20), spark_forest(df, 20, names=["a", "b"])
    assert trees(got, ["a", "b"], 20) == trees(want, ["a", "b"], 20)


def test_missing_values_and_no_rows_are_errors(spark):
    df = spark.createDataFrame([(1.0, None, 3.0), (2.0, 1.0, 4.0)], "a double, b double, y double")
    with pytest.raises(Exception, match="missing values"):
        ML.fit_forest(df, ["a", "b"], "y", trees=2)
    with pytest.raises(ValueError, match="needs rows"):
        ML.fit_forest(df.limit(0), ["a"], "y", trees=2)
    model = ML.fit_forest(df, ["a"], "y", trees=2)
    with pytest.raises(Exception, match="missing values"):
        ML.predict(model, df.withColumn("a", F.lit(None).cast("double")), ["a"]).collect()


def test_prediction_in_buckets_and_registry(spark, scratch, monkeypatch):
    rows = data(300, 7)
    df = frame(spark, rows, 4)
    model = ML.fit_forest(df, NAMES, "y", trees=9)
    once = sorted(tuple(r) for r in ML.predict(model, df, NAMES).collect())
    assert len(once) == len(rows) and ML.predict(model, df.limit(0), NAMES).count() == 0
    ML.save_model(spark, model, scratch, 24, ML.metadata_row("random_forest", "forest", 24, NAMES, None, {}))
    back, meta = ML.load_model(spark, scratch, 24)
    assert isinstance(back, R.Forest) and back.features == NAMES and meta["model_type"] == "forest"
    monkeypatch.setattr(R, "ROWS_AT_ONCE", 50)
    monkeypatch.setattr(R, "TREES_AT_ONCE", 2)
    again = sorted(tuple(r) for r in ML.predict(back, df, NAMES).collect())
    assert np.allclose(once, again, rtol=0, atol=1e-12)


def test_driver_holds_no_tree(spark):
    """A fitted forest is a stored table: what the driver keeps does not grow with its nodes."""
    model = ML.fit_forest(frame(spark, data(2000, 9)), NAMES, "y", trees=3)
    assert model.nodes.agg(F.sum(F.size("left"))).first()[0] > 3 * 1000
    assert len(json.dumps({k: v for k, v in vars(model).items() if k != "nodes"})) < 100
