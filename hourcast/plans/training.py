"""Training flow: exact-horizon targets, coverage-gated feature lists, null drops,
chronological split, per-split forward fill, candidate fits, metrics, choice of the best
model, registry write — for all horizons at once."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourcast.operators import boosting, linear
from hourcast.operators import ml as ML
from hourcast.operators import registry
from hourcast.operators.coverage import horizon_feature_cols
from hourcast.operators.windows import build_training_frame, chronological_split, forward_fill
from hourcast.schema import HORIZON_LAG_COLS, SERIES, TARGET_HORIZONS, TS, ordered_unique, target_column
from hourcast.session import reliable_checkpoint

CANDIDATES = ("random_forest", "ridge", "xgboost")


def training_frames(df: DataFrame, horizon: int, series=SERIES, ts=TS, strategy: str | None = None):
    tgt = target_column(horizon)
    frame = build_training_frame(df, horizon, series, ts, strategy=strategy)
    feats = horizon_feature_cols(frame, horizon)
    frame = frame.filter(F.col(tgt).isNotNull())
    lags = [c for c in HORIZON_LAG_COLS.get(horizon, []) if c in frame.columns]
    if lags:
        frame = frame.dropna(subset=lags)
    split = chronological_split(frame, 0.8, series, ts, strategy=strategy)
    filled = forward_fill(split, feats, partition=(series, "split"), ts=ts)
    return filled, feats, tgt


@dataclass
class Training:
    """metrics: horizon, model, rmse, mae, r2; models by (horizon, name); best name and
    feature list by horizon."""
    metrics: DataFrame
    best: dict[int, str]
    models: dict[tuple[int, str], object] = field(default_factory=dict)
    features: dict[int, list[str]] = field(default_factory=dict)
    registry_root: str | None = None


def horizon_rows(df: DataFrame, horizons=tuple(TARGET_HORIZONS), series=SERIES, ts=TS, strategy: str | None = None):
    """(rows of all horizons: horizon, series, ts, split, y and the union of the feature
    lists, NULL where a horizon has not got a feature; feature list by horizon)."""
    parts = {h: training_frames(df, h, series, ts, strategy) for h in horizons}
    union = ordered_unique([c for _, feats, _ in parts.values() for c in feats])
    out = None
    for h, (data, feats, tgt) in parts.items():
        cols = [F.col(c).cast("double").alias(c) if c in feats else F.lit(None).cast("double").alias(c) for c in union]
        rows = data.select(F.lit(h).alias("horizon"), series, ts, "split", F.col(tgt).alias("y"), *cols)
        out = rows if out is None else out.unionByName(rows)
    return out, {h: feats for h, (_, feats, _) in parts.items()}


def train_all(df: DataFrame, horizons=tuple(TARGET_HORIZONS), candidates=CANDIDATES, params: dict | None = None,
              series=SERIES, ts=TS, registry_root: str | None = None, skip_empty: bool = False) -> Training:
    """Fit every candidate for every horizon on its train split, score the test splits,
    choose by RMSE and publish each horizon's choice.

    The rows of all horizons are one stored table. Ridge takes all horizons' normal
    equations from one pass over it, boosting and forests grow the trees of all horizons in
    the same jobs, and one aggregate gives all metrics. A horizon without training rows is an error,
    or is left out with ``skip_empty``."""
    params = params or {}
    spark = df.sparkSession
    data, feats = horizon_rows(reliable_checkpoint(df), horizons, series, ts)
    data = reliable_checkpoint(data)
    train, test = data.filter("split = 'train'"), data.filter("split = 'test'")
    present = {r.horizon for r in train.select("horizon").distinct().collect()}
    for h in horizons:
        if h not in present:
            if not skip_empty:
                raise RuntimeError(f"No training rows for horizon {h}h")
            feats.pop(h)
    union = [c for c in data.columns if c not in ("horizon", series, ts, "split", "y")]
    out = Training(None, {}, {}, feats, registry_root)
    if "ridge" in candidates:
        sums = linear.moments(train, union, "y", ["horizon"])
        out.models |= {(h, "ridge"): linear.ridge(sums[h,], f, **params.get("ridge", {})) for h, f in feats.items()}
    if "xgboost" in candidates:
        grown = boosting.fit_groups(train, union, "y", ["horizon"], **{"rounds": ML.GBT_ROUNDS, "step": ML.GBT_STEP, "depth": ML.GBT_DEPTH,
                                                                       **params.get("xgboost", {})})
        out.models |= {(h, "xgboost"): grown[h,].narrowed(f) for h, f in feats.items()}
    if "random_forest" in candidates:
        lists = {(h,): f for h, f in feats.items()}
        grown = ML.fit_forests(train, union, "y", ["horizon"], lists, **params.get("random_forest", {}))
        out.models |= {(h, "random_forest"): grown[h,] for h in feats}
    scored = None
    for (h, name), model in out.models.items():
        rows = test.filter(F.col("horizon") == h).select("horizon", "y", *feats[h])
        p = ML.predict(model, rows, feats[h]).select("horizon", F.lit(name).alias("model"), "y", "prediction")
        scored = p if scored is None else scored.unionByName(p)
    if scored is None:
        out.metrics = spark.createDataFrame([], "horizon int, model string, rmse double, mae double, r2 double")
        return out
    # A few rows; they outlive the stored table.
    metrics = ML.regression_metrics(scored, ["horizon", "model"], "y", "prediction")
    out.metrics = spark.createDataFrame(metrics.collect(), metrics.schema)
    out.best = {r.horizon: r.model for r in ML.best_model(out.metrics).collect()}
    if registry_root is not None:
        every: dict[int, dict] = {}
        for r in out.metrics.collect():
            every.setdefault(r.horizon, {})[r.model] = {"rmse": r.rmse, "mae": r.mae, "r2": r.r2}
        for h, name in out.best.items():
            model = out.models[h, name]
            meta = ML.metadata_row(name, registry.model_type(model), h, feats[h], every[h][name], every[h])
            ML.save_model(spark, model, registry_root, h, meta)
    return out


def train_for_horizon(df: DataFrame, horizon: int, candidates=CANDIDATES, params: dict | None = None,
                      series=SERIES, ts=TS, registry_root: str | None = None):
    """One horizon of :func:`train_all`: (metrics DataFrame, best name, models dict, feature list)."""
    t = train_all(df, (horizon,), candidates, params, series, ts, registry_root)
    return t.metrics, t.best.get(horizon), {name: m for (_, name), m in t.models.items()}, t.features[horizon]
