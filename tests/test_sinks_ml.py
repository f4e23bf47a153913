import os

from pyspark.sql import functions as F

from hourcast.operators import ml as ML
from hourcast.operators.sinks import append_new, stored_rows
from hourcast.operators.windows import add_engineered_features
from tests.helpers import hours


def _rows(spark, hrs, series="s"):
    return spark.createDataFrame([(series, hours(h), float(h)) for h in hrs],
                                 "series string, timestamp timestamp_ntz, aqi double")


def test_append_is_idempotent(spark, scratch):
    path = os.path.join(scratch, "table")
    feats = add_engineered_features(_rows(spark, range(30)))
    assert append_new(spark, feats, path) == 30
    assert append_new(spark, feats, path) == 0
    dup = feats.unionByName(feats)
    assert append_new(spark, dup, path) == 0
    late = add_engineered_features(_rows(spark, [100]))
    assert append_new(spark, late.unionByName(late), path) == 1
    stored = stored_rows(spark, path)
    assert stored.count() == 31
    assert "hours_since_prev" not in stored.columns and "is_gap" not in stored.columns
    assert dict(stored.dtypes)["hour_of_day"] == "bigint"


def test_registry_round_trip(spark, scratch):
    df = spark.createDataFrame([(float(x), 2.0 * x + 1.0) for x in range(50)], "x double, y double")
    model = ML.fit_ridge(df, ["x"], "y", alpha=1.0)
    meta = ML.metadata_row("ridge", "spark_ml", 24, ["x"], {"rmse": 0.1, "mae": 0.1, "r2": 0.9},
                           {"ridge": {"rmse": 0.1, "mae": 0.1, "r2": 0.9}})
    ML.save_model(spark, model, scratch, 24, meta)
    loaded, got = ML.load_model(spark, scratch, 24)
    assert got["model_name"] == "ridge" and got["features"] == ["x"] and got["all_model_metrics"]["ridge"]["r2"] == 0.9
    assert abs(loaded.coefficients[0] - model.coefficients[0]) < 1e-12


def test_ridge_matches_closed_form(spark):
    import numpy as np
    rng = np.random.default_rng(1)
    x = rng.normal(50, 10, 200)
    y = 0.7 * x + rng.normal(0, 5, 200)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double")
    m = ML.fit_ridge(df, ["x"], "y", alpha=1.0)
    xc, yc = x - x.mean(), y - y.mean()
    slope = (xc * yc).sum() / ((xc * xc).sum() + 1.0)
    assert abs(m.coefficients[0] - slope) < 1e-7


def test_best_model_tie_prefers_forest(spark):
    m = spark.createDataFrame([(24, "ridge", 1.0), (24, "random_forest", 1.0), (24, "xgboost", 2.0)],
                              "horizon int, model string, rmse double")
    assert ML.best_model(m).first().model == "random_forest"


def test_training_flow_smoke(spark, scratch):
    from hourcast.plans.training import train_for_horizon
    import math
    rows = [("s", hours(h), 50 + 20 * math.sin(h / 5.0) + (h % 7), 30.0 + h % 5) for h in range(400)]
    df = spark.createDataFrame(rows, "series string, timestamp timestamp_ntz, aqi double, pm25 double")
    df = add_engineered_features(df)
    metrics, best, models, feats = train_for_horizon(df, 24, candidates=("random_forest", "ridge"),
                                                     params={"random_forest": {"trees": 5}}, registry_root=scratch)
    assert best in ("random_forest", "ridge") and metrics.count() == 2
    assert "aqi_lag_24h" in feats and "fc_co_24h" not in feats
    _, meta = ML.load_model(spark, scratch, 24)
    assert meta["model_name"] == best


def test_alerts(spark):
    from hourcast.plans.scoring import alerts
    p = spark.createDataFrame([("s", 24, 150.0), ("s", 48, 150.1), ("s", 72, 90.0)],
                              "series string, horizon int, prediction double")
    r = alerts(p).first()
    assert r.alert is True and r.horizons == "48h"


def test_empty_guards(spark):
    import pytest
    from hourcast.plans.training import train_for_horizon
    empty = spark.createDataFrame([], "series string, timestamp timestamp_ntz, aqi double")
    with pytest.raises(RuntimeError):
        train_for_horizon(add_engineered_features(empty), 24, candidates=("ridge",))
    assert F is not None


def test_late_row_appended_once_without_rewriting(spark, scratch):
    from hourcast.streaming.jobs import features_for_batch
    path = os.path.join(scratch, "late")
    hrs = [h for h in range(31) if h != 20]
    append_new(spark, features_for_batch(spark, _rows(spark, hrs), path), path)
    before = {r.timestamp: r.aqi_lag_1h for r in stored_rows(spark, path).collect()}
    late = _rows(spark, [20])
    assert append_new(spark, features_for_batch(spark, late, path), path) == 1
    assert append_new(spark, features_for_batch(spark, late, path), path) == 0
    after = {r.timestamp: r.aqi_lag_1h for r in stored_rows(spark, path).collect()}
    assert len(after) == 31 and all(after[t] == before[t] for t in before)


def test_local_surrogate_recovers_linear_model(spark):
    """For a linear model the surrogate's weights are coef * std (scaled space)."""
    import numpy as np
    rng = np.random.default_rng(2)
    rows = [("s", hours(i), float(a), float(b), float(3 * a - 2 * b + 5))
            for i, (a, b) in enumerate(zip(rng.normal(10, 2, 300), rng.normal(0, 1, 300)))]
    df = spark.createDataFrame(rows, "series string, timestamp timestamp_ntz, a double, b double, y double")
    model = ML.fit_ridge(df, ["a", "b"], "y", alpha=0.0)
    out = {r.feature: r.weight for r in ML.local_surrogate(model, df, ["a", "b"], n_samples=2000).collect()}
    bg = df.orderBy(F.col("timestamp").desc()).limit(300).toPandas()
    assert abs(out["a"] - 3 * bg.a.std()) < 0.05 * 3 * bg.a.std()
    assert abs(out["b"] + 2 * bg.b.std()) < 0.05 * 2 * bg.b.std()


def test_latest_n_then_filter_limit_first(spark):
    from hourcast.operators.ordering import latest_n_then_filter
    rows = [("s", hours(i), None if i % 25 == 0 else float(i)) for i in range(600)]
    df = spark.createDataFrame(rows, "series string, timestamp timestamp_ntz, aqi double")
    out = latest_n_then_filter(df, 500, F.col("aqi").isNotNull())
    assert out.count() == 480


def test_coverage_gate_threshold(spark):
    from hourcast.operators.coverage import horizon_feature_cols
    rows = [("s", hours(i), 1.0, 1.0 if i < 5 else None, 1.0 if i < 4 else None) for i in range(100)]
    df = spark.createDataFrame(rows, "series string, timestamp timestamp_ntz, aqi double, fc_co_24h double, fc_no2_24h double")
    cols = horizon_feature_cols(df, 24)
    assert "fc_co_24h" in cols and "fc_no2_24h" not in cols and "aqi" in cols


def test_carry_forward_fallback(spark):
    from hourcast.operators.ordering import carry_forward
    hist = spark.createDataFrame([("a", hours(1), 5.0), ("a", hours(3), 7.0)],
                                 "series string, timestamp timestamp_ntz, aqi double")
    ser = spark.createDataFrame([("a",), ("b",)], "series string")
    got = {r.series: (r.timestamp, r.aqi) for r in carry_forward(hist, ser, "2024-01-02 10:45:00").collect()}
    assert got["a"][1] == 7.0 and got["b"][1] is None
    assert str(got["a"][0]) == "2024-01-02 10:00:00" == str(got["b"][0])


def test_permutation_is_a_bijection_and_importance_ranks(spark, monkeypatch):
    import numpy as np
    monkeypatch.setattr(ML, "PERMUTATION_BUCKET_ROWS", 50)
    rng = np.random.default_rng(4)
    rows = [(float(a), float(b), float(5 * a + 0.1 * b)) for a, b in zip(rng.normal(0, 1, 400), rng.normal(0, 1, 400))]
    df = spark.createDataFrame(rows, "a double, b double, y double")
    perm = ML.permute_column(df, "a", seed=3)
    assert sorted(r.a for r in perm.collect()) == sorted(r.a for r in df.collect())
    assert perm.count() == 400
    model = ML.fit_ridge(df, ["a", "b"], "y", alpha=0.0)
    imp = {r.feature: r.importance for r in ML.permutation_importance(model, df, ["a", "b"], "y").collect()}
    assert imp["a"] > 10 * imp["b"] > 0


def test_normalised_importances(spark):
    import numpy as np
    rng = np.random.default_rng(6)
    rows = [(float(a), float(b), float(3 * a)) for a, b in zip(rng.normal(0, 1, 200), rng.normal(0, 1, 200))]
    df = spark.createDataFrame(rows, "a double, b double, y double")
    model = ML.fit_forest(df, ["a", "b"], "y", trees=5)
    w = ML.normalised_importances(model, ["a", "b"])
    assert abs(sum(w) - 1.0) < 1e-9 and w[0] > w[1]


def _aqi_history(spark, n=400):
    import math
    rows = [("s", hours(h), 50 + 20 * math.sin(h / 5.0) + (h % 7), 30.0 + h % 5) for h in range(n)]
    return add_engineered_features(spark.createDataFrame(rows, "series string, timestamp timestamp_ntz, aqi double, pm25 double"))


def test_all_horizons_and_candidates(spark, scratch):
    from hourcast.plans.training import train_all, train_for_horizon
    df = _aqi_history(spark)
    params = {"random_forest": {"trees": 3}, "xgboost": {"rounds": 4}}
    t = train_all(df, params=params, registry_root=scratch)
    assert set(t.models) == {(h, m) for h in (24, 48, 72) for m in ("random_forest", "ridge", "xgboost")}
    got = {(r.horizon, r.model): (r.rmse, r.mae, r.r2) for r in t.metrics.collect()}
    assert len(got) == 9
    assert "aqi_lag_1h" in t.features[24] and "aqi_lag_1h" not in t.features[48] and "aqi_lag_6h" not in t.features[72]
    for h in (24, 48, 72):
        model, meta = ML.load_model(spark, scratch, h)
        assert meta["model_name"] == t.best[h] == min(("random_forest", "ridge", "xgboost"), key=lambda m: got[h, m][0])
        assert meta["features"] == t.features[h] and set(meta["all_model_metrics"]) == {"random_forest", "ridge", "xgboost"}
        assert meta["lookback_window"] == 24
        # The model read back predicts as the one trained.
        rows = df.dropna().limit(20)
        a, b = (sorted(r.prediction for r in ML.predict(m, rows, t.features[h]).collect()) for m in (model, t.models[h, t.best[h]]))
        assert a == b
    # One horizon alone: the same ridge.
    m, _, _, _ = train_for_horizon(df, 48, candidates=("ridge",))
    assert tuple(m.first())[2:] == got[48, "ridge"]


def test_registry_survives_a_killed_writer(spark, scratch, monkeypatch):
    import pytest
    from hourcast.operators import registry
    from hourcast.operators.linear import LinearModel
    with pytest.raises(RuntimeError, match="metadata missing"):
        ML.load_model(spark, scratch, 24)
    old, new = LinearModel(["a"], [2.0], 1.0), LinearModel(["b"], [5.0], 0.0)
    ML.save_model(spark, old, scratch, 24, ML.metadata_row("ridge", "linear", 24, ["a"], None, {}))
    swap = registry._point

    def dies(*_):
        raise OSError("killed")

    # Killed before the pointer is swapped, and while the model is half written.
    for target in ("_point", "_write_model"):
        monkeypatch.setattr(registry, target, dies)
        with pytest.raises(OSError):
            ML.save_model(spark, new, scratch, 24, ML.metadata_row("ridge", "linear", 24, ["b"], None, {}))
        monkeypatch.undo()
        model, meta = ML.load_model(spark, scratch, 24)
        assert model == old and meta["features"] == ["a"]
    assert registry._point is swap
    # A reader that follows the old pointer still reads a whole version after the swap.
    at = registry.latest_version(spark, scratch, 24)
    ML.save_model(spark, new, scratch, 24, ML.metadata_row("ridge", "linear", 24, ["b"], None, {}))
    assert ML.load_model(spark, scratch, 24)[0] == new
    assert registry._read_model(spark, os.path.join(scratch, "models/aqi_model_24h/versions", at)) == old


def test_registry_defaults(spark, scratch):
    from hourcast.operators.linear import LinearModel
    from hourcast.schema import feature_columns
    ML.save_model(spark, LinearModel(["a"], [1.0], 0.0), scratch, 48, {"horizon_hours": 48})
    _, meta = ML.load_model(spark, scratch, 48)
    assert meta == {"model_name": "aqi_model_48h", "model_type": "sklearn", "horizon_hours": 48, "features": feature_columns(),
                    "lookback_window": 24, "metrics": {}, "all_model_metrics": {}}


def test_boosted_model_in_the_registry(spark, scratch):
    from hourcast.operators.boosting import Booster
    df = _aqi_history(spark, 120).dropna()
    model = ML.fit_boosted(df, ["aqi_lag_1h", "pm25"], "aqi", rounds=3)
    ML.save_model(spark, model, scratch, 24, ML.metadata_row("xgboost", "boosted", 24, model.features, None, {}))
    back, _ = ML.load_model(spark, scratch, 24)
    assert isinstance(back, Booster)
    a, b = ([r.prediction for r in ML.predict(m, df, model.features).orderBy("timestamp").collect()] for m in (model, back))
    assert a == b


def test_surrogate_equals_numpy(spark):
    """Draws, kernel weights and both ridge solves against numpy on the same samples."""
    import numpy as np
    from hourcast.operators.linear import LinearModel
    rng = np.random.default_rng(8)
    names = [f"f{i}" for i in range(5)]
    rows = [(s, hours(i), *[float(v) for v in rng.normal(k, 1 + k, 5)]) for k, s in enumerate(("p", "q")) for i in range(60)]
    df = spark.createDataFrame(rows, "series string, timestamp timestamp_ntz, " + ", ".join(f"{c} double" for c in names))
    model = LinearModel(names, [3.0, -2.0, 0.5, 0.0, 1.0], 7.0)
    got = {(r.series, r.feature): r.weight for r in ML.local_surrogate(model, df, names, n_samples=300, top=3).collect()}
    assert len(got) == 6
    samples = ML.predict(model, ML.surrogate_samples(df, names, 300), names).toPandas()
    for s, part in samples.groupby("series"):
        x = np.column_stack([(part[c] - part[f"_m_{c}"]) / part[f"_s_{c}"] for c in names])
        y, w = part.prediction.to_numpy(), part.kernel_weight.to_numpy()

        def ridge(x):
            xm, ym = np.average(x, 0, w), np.average(y, weights=w)
            xc, yc = x - xm, y - ym
            return np.linalg.solve((xc * w[:, None]).T @ xc + np.eye(x.shape[1]), (xc * w[:, None]).T @ yc)

        pick = np.argsort(-np.abs(ridge(x)), kind="stable")[:3]
        for i, v in zip(pick, ridge(x[:, pick])):
            assert abs(got[s, names[i]] - v) < 1e-8
    again = {(r.series, r.feature): r.weight for r in ML.local_surrogate(model, df.repartition(7), names, n_samples=300, top=3).collect()}
    assert all(abs(again[k] - got[k]) < 1e-9 for k in got)
