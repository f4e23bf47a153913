"""Model data operators on Spark ML: metrics, ridge/forest/boosting fits,
model choice, comparison tables, registry I/O and explanation proxies."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourcast.functions.numeric import round_stable
from hourcast.operators import boosting, forest
from hourcast.operators.linear import LinearModel
from hourcast.operators.registry import load_model, save_model  # noqa: F401 (part of this module's interface)
from hourcast.operators.stats import inv_norm
from hourcast.schema import MODEL_PREFERRED_ORDER, SERIES, TS

# ---- fixed values: candidate hyper-parameters -----------------------------------------------
RF_TREES = 300
RF_SEED = 42
RIDGE_ALPHA = 1.0
GBT_ROUNDS = 300
GBT_STEP = 0.05
GBT_DEPTH = 6
SPARK_MAX_DEPTH = 30  # Spark's deepest tree (sklearn forests are unbounded)
# -----------------------------------------------------------------------------------------------


# Node statistics a task may hold; less memory grows the same trees in more steps.
TREE_MEMORY_MB = 256


def regression_metrics(pred: DataFrame, keys, label: str = "y", prediction: str = "prediction",
                       decimals: int | None = 4) -> DataFrame:
    """rmse, mae, r2 per group in one pass (r2 = 1 - SSE / SST)."""
    e = F.col(label) - F.col(prediction)
    agg = pred.groupBy(*keys).agg(
        F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"),
        (F.lit(1.0) - F.sum(e * e) / (F.var_pop(label) * F.count(label))).alias("r2"))
    if decimals is None:
        return agg
    return agg.withColumns({c: round_stable(c, decimals) for c in ("rmse", "mae", "r2")})


def assembler(features, out: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="error")


def ridge_reg_param(df: DataFrame, label: str, alpha: float = RIDGE_ALPHA) -> float:
    """Spark's normal-equation solver scales the L2 term by the label std and
    the row count; this maps sklearn's ``alpha`` (unstandardised, summed loss)
    onto ``regParam`` (one-row driver profile)."""
    r = df.agg(F.stddev_pop(label).alias("sd"), F.count(label).alias("n")).first()
    if not r or not r.n or not r.sd:
        return 0.0
    return alpha * float(r.sd) / float(r.n)


def fit_ridge(df: DataFrame, features, label: str, alpha: float = RIDGE_ALPHA):
    lr = LinearRegression(featuresCol="features", labelCol=label, elasticNetParam=0.0, standardization=False,
                          solver="normal", regParam=ridge_reg_param(df, label, alpha), fitIntercept=True)
    return lr.fit(assembler(features).transform(df))


def fit_forest(df: DataFrame, features, label: str, trees: int = RF_TREES, seed: int = RF_SEED,
               memory_mb: int = TREE_MEMORY_MB, depth: int = SPARK_MAX_DEPTH, bootstrap: bool = True, max_bins: int = 32) -> forest.Forest:
    fitted = fit_forests(df, features, label, (), None, trees, seed, memory_mb, depth, bootstrap, max_bins)
    if not fitted:
        raise ValueError("a forest needs rows")
    return fitted[()]


def fit_forests(df: DataFrame, features, label: str, groups, lists=None, trees: int = RF_TREES, seed: int = RF_SEED,
                memory_mb: int = TREE_MEMORY_MB, depth: int = SPARK_MAX_DEPTH, bootstrap: bool = True,
                max_bins: int = 32) -> dict[tuple, forest.Forest]:
    """:func:`fit_forest` of all groups at once, each over its features in ``lists``."""
    return forest.fit_groups(df, features, label, groups, lists, trees, seed, memory_mb, depth, bootstrap, max_bins)


def fit_boosted(df: DataFrame, features, label: str, rounds: int = GBT_ROUNDS) -> boosting.Booster:
    return boosting.fit_groups(df, features, label, rounds=rounds, step=GBT_STEP, depth=GBT_DEPTH)[()]


FITTERS = {"random_forest": fit_forest, "ridge": fit_ridge, "xgboost": fit_boosted}


def predict(model, df: DataFrame, features) -> DataFrame:
    """``df`` with ``prediction``: a linear model is an expression, a boosted one walks its
    trees in Arrow batches, a forest's rows meet its stored trees, a Spark ML model
    transforms assembled vectors."""
    if isinstance(model, LinearModel):
        return df.withColumn("prediction", model.column())
    if isinstance(model, boosting.Booster):
        return boosting.predict_groups(df, {(): model})
    if isinstance(model, forest.Forest):
        return forest.predict(df, model)
    return model.transform(assembler(features).transform(df)).drop("features")


def best_model(metrics: DataFrame, group=("horizon",), order=MODEL_PREFERRED_ORDER) -> DataFrame:
    """Lowest RMSE per group; ties go to the earlier candidate in ``order``."""
    pos = F.array_position(F.array(*[F.lit(m) for m in order]), F.col("model"))
    pos = F.when(pos == 0, F.lit(len(order) + 1)).otherwise(pos)
    w = Window.partitionBy(*group).orderBy(F.col("rmse"), pos, F.col("model"))
    return metrics.withColumn("_rk", F.row_number().over(w)).filter("_rk = 1").drop("_rk")


def comparison_frame(meta: DataFrame, order=MODEL_PREFERRED_ORDER) -> DataFrame:
    """Metadata rows (model_name, metrics, all_model_metrics) -> one row per
    candidate: preferred order first, others after in map order; the chosen
    model is added when missing from the map."""
    m = F.when(F.col("all_model_metrics").isNull(), F.create_map()).otherwise(F.col("all_model_metrics"))
    m = F.when(F.map_contains_key(m, F.col("model_name")), m).otherwise(
        F.map_concat(m, F.create_map(F.col("model_name"), F.col("metrics"))))
    ex = meta.select("horizon_hours", F.posexplode(F.map_entries(m)).alias("_i", "_e"))
    pref = F.array_position(F.array(*[F.lit(x) for x in order]), F.col("_e.key"))
    rank = F.when(pref > 0, pref).otherwise(F.lit(len(order)) + F.col("_i") + 1)
    return ex.select("horizon_hours", F.col("_e.key").alias("model"),
                     F.upper(F.regexp_replace(F.col("_e.key"), "_", " ")).alias("label"),
                     F.col("_e.value.rmse").alias("rmse"), F.col("_e.value.mae").alias("mae"),
                     F.col("_e.value.r2").alias("r2"), rank.alias("display_order"))


def display_names(comparison: DataFrame) -> DataFrame:
    """The comparison table under its display names."""
    return comparison.select("horizon_hours", F.col("label").alias("model"), F.col("rmse").alias("RMSE"), F.col("mae").alias("MAE"),
                             F.col("r2").alias("R²"))


def format_metric(c) -> "F.Column":
    col = F.col(c) if isinstance(c, str) else c
    return F.when(col.isNull() | F.isnan(col), F.lit("-")).otherwise(F.format_string("%.4f", col))


def linear_contributions(df: DataFrame, features, coefficients, series=SERIES) -> DataFrame:
    """Mean |coef_j * (x_j - mean(x_j))| per feature (exact linear explanation)."""
    means = df.groupBy(series).agg(*[F.avg(c).alias(f"_m_{c}") for c in features])
    j = df.join(means, series)
    agg = j.groupBy(series).agg(*[F.avg(F.abs(F.lit(float(w)) * (F.col(c) - F.col(f"_m_{c}")))).alias(c)
                                  for c, w in zip(features, coefficients)])
    stack = ", ".join(f"'{c}', `{c}`" for c in features)
    return agg.selectExpr(series, f"stack({len(features)}, {stack}) AS (feature, importance)")


def local_proxy(history: DataFrame, features, weights=None, background: int = 500, series=SERIES, ts=TS) -> DataFrame:
    """(x_newest - mean) / std * weight per feature over the newest
    ``background`` rows of each series; std 0 or NULL -> 1; weights default 1."""
    w = Window.partitionBy(series).orderBy(F.col(ts).desc())
    bg = history.withColumn("_rk", F.row_number().over(w)).filter(F.col("_rk") <= background)
    stats = bg.groupBy(series).agg(*[F.avg(c).alias(f"_m_{c}") for c in features],
                                   *[F.stddev_samp(c).alias(f"_s_{c}") for c in features])
    newest = bg.filter(F.col("_rk") == 1).select(series, *features)
    j = newest.join(stats, series)
    weights = weights or [1.0] * len(features)
    total = sum(abs(x) for x in weights) or 1.0
    cols = []
    for c, wt in zip(features, weights):
        sd = F.when(F.col(f"_s_{c}").isNull() | (F.col(f"_s_{c}") == 0), F.lit(1.0)).otherwise(F.col(f"_s_{c}"))
        cols.append(((F.col(c) - F.col(f"_m_{c}")) / sd * F.lit(wt / total)).alias(c))
    wide = j.select(series, *cols)
    stack = ", ".join(f"'{c}', `{c}`" for c in features)
    return wide.selectExpr(series, f"stack({len(features)}, {stack}) AS (feature, weight)")


def normalised_importances(model, features) -> list[float]:
    imp = model.importances() if isinstance(model, (boosting.Booster, forest.Forest)) else model.featureImportances.toArray()
    imp = [abs(float(x)) for x in imp]
    total = sum(imp)
    return [x / total for x in imp] if total > 0 else imp


def metadata_row(name: str, model_type: str, horizon: int, features, metrics: dict, all_metrics: dict) -> dict:
    return {"model_name": name, "model_type": model_type, "horizon_hours": horizon, "features": list(features),
            "metrics": metrics, "all_model_metrics": all_metrics}


# ---- fixed values: local surrogate explanation -------------------------------------------------
SURROGATE_SAMPLES = 5000
SURROGATE_KERNEL = 0.75          # kernel width = 0.75 * sqrt(n_features)
SURROGATE_RIDGE_ALPHA = 1.0
SURROGATE_TOP = 10
SURROGATE_SEED = 42
# -----------------------------------------------------------------------------------------------


def uniform_draw(*key: Column) -> Column:
    """A uniform number in (0, 1) that depends on the key alone: 48 bits of its MD5. Any
    task, rerun or engine draws the same."""
    bits = F.conv(F.substring(F.md5(F.concat_ws("|", *[k.cast("string") for k in key])), 1, 12), 16, 10).cast("double")
    return (bits + F.lit(0.5)) / F.lit(float(1 << 48))


def surrogate_samples(history: DataFrame, features, n_samples: int = SURROGATE_SAMPLES, seed: int = SURROGATE_SEED,
                      background: int = 500, series=SERIES, ts=TS) -> DataFrame:
    """Per series: sample 0 is the newest row, samples 1..n are drawn from N(mean, std) of
    the newest ``background`` rows (std 0/NULL -> 1). A draw is the inverse normal of a
    uniform number made of (series, sample, feature, seed), so reruns agree. Columns:
    series, sample, features..., and the scaled distance-kernel weight."""
    w = Window.partitionBy(series).orderBy(F.col(ts).desc())
    bg = history.withColumn("_rk", F.row_number().over(w)).filter(F.col("_rk") <= background)
    stats = bg.groupBy(series).agg(*[F.avg(c).alias(f"_m_{c}") for c in features],
                                   *[F.stddev_samp(c).alias(f"_s_{c}") for c in features],
                                   *[F.max_by(c, F.lit(1) - F.col("_rk")).alias(f"_x0_{c}") for c in features])
    stats = stats.withColumns({f"_s_{c}": F.when(F.col(f"_s_{c}").isNull() | (F.col(f"_s_{c}") == 0), F.lit(1.0))
                               .otherwise(F.col(f"_s_{c}")) for c in features})
    gen = stats.withColumn("sample", F.explode(F.sequence(F.lit(0), F.lit(n_samples))))
    names = F.array(*[F.lit(c) for c in features])
    draws = F.transform(F.transform(names, lambda c: uniform_draw(F.col(series), F.col("sample"), c, F.lit(seed))), inv_norm)
    gen = gen.withColumn("_z", draws)
    gen = gen.withColumns({c: F.when(F.col("sample") == 0, F.col(f"_x0_{c}")).otherwise(F.col(f"_m_{c}") + F.get("_z", F.lit(i)) * F.col(f"_s_{c}"))
                           for i, c in enumerate(features)})
    d2 = sum(((F.col(c) - F.col(f"_x0_{c}")) / F.col(f"_s_{c}")) ** 2 for c in features)
    width = SURROGATE_KERNEL * (len(features) ** 0.5)
    gen = gen.withColumn("kernel_weight", F.sqrt(F.exp(-d2 / F.lit(width * width))))
    keep = [series, "sample", *features, "kernel_weight", *[f"_m_{c}" for c in features], *[f"_s_{c}" for c in features]]
    return gen.select(*keep)


def solve_symmetric(matrix: Column, k: int) -> Column:
    """Solution of a positive definite system from its k rows of k + 1 numbers (the last is
    the right side): Gauss-Jordan as a fold over the pivots."""
    def step(m: Column, p: Column) -> Column:
        pivot = F.get(m, p)

        def reduced(row: Column, i: Column) -> Column:
            scaled = F.transform(pivot, lambda v: v / F.get(pivot, p))
            return F.when(i == p, scaled).otherwise(F.zip_with(row, scaled, lambda a, b: a - F.get(row, p) * b))

        return F.transform(m, reduced)

    return F.transform(F.aggregate(F.sequence(F.lit(0), F.lit(k - 1)), matrix, step), lambda row: F.get(row, F.lit(k)))


def weighted_ridge(rows: DataFrame, features, label: str, weight: str, alpha: float, top: int, series=SERIES) -> DataFrame:
    """series, coefficients (array, 0 outside the pick): per series a ridge with weighted
    rows and a free intercept, refitted on its ``top`` features by |coefficient| (ties: the
    earlier). All sums of products of a series are one aggregate over pairs of columns;
    the systems, of the size of the feature list, are solved as expressions."""
    k = len(features)
    z = F.array(F.lit(1.0), *[F.col(c).cast("double") for c in features], F.col(label).cast("double"))
    pairs = F.array(*[F.struct(F.lit(i * (k + 2) + j).alias("at"), (F.get("_z", F.lit(i)) * F.get("_z", F.lit(j)) * F.col("_w")).alias("v"))
                      for i in range(k + 2) for j in range(i, k + 2)])
    sums = rows.select(series, F.col(weight).alias("_w"), z.alias("_z")).select(series, F.explode(pairs).alias("p"))
    sums = sums.groupBy(series, "p.at").agg(F.sum("p.v").alias("v"))
    m = sums.groupBy(series).agg(F.map_from_entries(F.collect_list(F.struct("at", "v"))).alias("m"))

    def s(i: Column, j: Column) -> Column:
        return F.element_at("m", (F.least(i, j) * (k + 2) + F.greatest(i, j)).cast("int"))

    zero = F.lit(0)
    centred = F.transform(F.sequence(F.lit(1), F.lit(k)), lambda i: F.transform(
        F.sequence(F.lit(1), F.lit(k + 1)), lambda j: s(i, j) - s(zero, i) * s(zero, j) / s(zero, zero)))
    m = m.select(series, centred.alias("c"))

    def system(c: Column, kept: Column) -> Column:
        def cell(v: Column, i: Column, j: Column) -> Column:
            inside = F.get(kept, i) & ((j == k) | F.get(kept, F.least(j, F.lit(k - 1))))
            return F.when(inside, v).otherwise(F.lit(0.0)) + F.when(i == j, F.lit(float(alpha))).otherwise(F.lit(0.0))
        return F.transform(c, lambda row, i: F.transform(row, lambda v, j: cell(v, i, j)))

    m = m.withColumn("w", solve_symmetric(system(F.col("c"), F.array_repeat(F.lit(True), k)), k))
    order = F.array_sort(F.transform("w", lambda v, i: F.struct((-F.abs(v)).alias("a"), i.alias("i"))))
    m = m.withColumn("pick", F.slice(F.transform(order, lambda t: t["i"]), 1, top))
    kept = F.transform("w", lambda v, i: F.array_contains("pick", i))
    m = m.withColumn("kept", kept)
    return m.select(series, "kept", solve_symmetric(system(F.col("c"), F.col("kept")), k).alias("coefficients"))


def local_surrogate(model, history: DataFrame, features, n_samples: int = SURROGATE_SAMPLES,
                    top: int = SURROGATE_TOP, series=SERIES, ts=TS) -> DataFrame:
    """Weighted ridge fitted to the model's predictions around the newest row of each series:
    series, feature, weight of its ``top`` features."""
    samples = surrogate_samples(history, features, n_samples, series=series, ts=ts)
    scored = predict(model, samples, features)
    scaled = scored.select(series, "kernel_weight", "prediction",
                           *[((F.col(c) - F.col(f"_m_{c}")) / F.col(f"_s_{c}")).alias(c) for c in features])
    fit = weighted_ridge(scaled, features, "prediction", "kernel_weight", SURROGATE_RIDGE_ALPHA, top, series)
    names = F.array(*[F.lit(c) for c in features])
    each = fit.select(series, F.explode(F.arrays_zip(names.alias("feature"), F.col("coefficients").alias("weight"), F.col("kept").alias("kept"))).alias("e"))
    return each.filter("e.kept").select(series, "e.feature", "e.weight")


# ---- fixed values: dashboard quality classes and horizon confidence --------------------------------
R2_CLASS_BOUNDS = [0.35, 0.10]          # >= good, >= mid, else bad
RMSE_CLASS_BOUNDS = [12, 18]            # <= good, <= mid, else bad
QUALITY_CLASSES = ["metric-good", "metric-mid", "metric-bad"]
CONFIDENCE_LABELS = [(24, "High confidence", 90), (48, "Medium confidence", 65), (72, "Indicative only", 35)]
# -----------------------------------------------------------------------------------------------------


def quality_classes(df: DataFrame) -> DataFrame:
    """r2 / rmse display classes (NULL metric -> empty class)."""
    from hourcast.functions.aqi import threshold_label
    r2 = F.when(F.col("r2").isNull(), F.lit("")).otherwise(
        threshold_label("r2", R2_CLASS_BOUNDS, QUALITY_CLASSES, descending=True))
    rmse = F.when(F.col("rmse").isNull(), F.lit("")).otherwise(
        threshold_label("rmse", RMSE_CLASS_BOUNDS, QUALITY_CLASSES))
    return df.withColumns({"r2_class": r2, "rmse_class": rmse})


def confidence_columns(horizon_col: str = "horizon") -> dict:
    h = F.col(horizon_col)
    label, pct = None, None
    for hh, lab, p in CONFIDENCE_LABELS:
        label = F.when(h == hh, F.lit(lab)) if label is None else label.when(h == hh, F.lit(lab))
        pct = F.when(h == hh, F.lit(p)) if pct is None else pct.when(h == hh, F.lit(p))
    return {"confidence": label, "confidence_pct": pct}


PERMUTATION_BUCKET_ROWS = 100_000  # rows per permutation bucket


def permute_column(df: DataFrame, column: str, seed: int = 42, key=None) -> DataFrame:
    """Random permutation of one column without a global sort: rows are spread over hash
    buckets sized ~``PERMUTATION_BUCKET_ROWS``; inside each bucket the rows are paired by two
    independent random orders (a bijection per bucket). The orders are drawn from the row's
    ``key`` columns (default: all columns, equal rows being alike), so reruns agree."""
    key = list(key or df.columns)
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key]
    n = df.count()
    buckets = max(1, -(-n // PERMUTATION_BUCKET_ROWS))
    bucket = F.floor(uniform_draw(*text, F.lit(seed), F.lit("bucket")) * buckets)
    # materialised so both sides see the same number of every row
    staged = _materialise(df.withColumns({"_pb": bucket, "_pa": uniform_draw(*text, F.lit(seed), F.lit("rows")),
                                          "_pc": uniform_draw(*text, F.lit(seed), F.lit("values")), "_pi": F.monotonically_increasing_id()}))
    rows = staged.withColumn("_pr", F.row_number().over(Window.partitionBy("_pb").orderBy("_pa", "_pi"))).drop(column)
    vals = staged.select("_pb", F.col(column).alias("_pv"), F.row_number().over(Window.partitionBy("_pb").orderBy("_pc", "_pi")).alias("_pr"))
    return rows.join(vals, ["_pb", "_pr"]).withColumnRenamed("_pv", column).select(*df.columns)


def _materialise(df: DataFrame) -> DataFrame:
    from hourcast.session import reliable_checkpoint
    return reliable_checkpoint(df)


def permutation_importance(model, df: DataFrame, features, label: str, seed: int = 42, key=()) -> DataFrame:
    """Increase of RMSE when each feature is permuted (model-agnostic); ``key`` names the
    columns that the permutations are drawn from."""
    spark = df.sparkSession
    base = _materialise(df.select(*dict.fromkeys([*key, *features, label])))

    def rmse(frame: DataFrame) -> float:
        p = predict(model, frame, features)
        return float(p.agg(F.sqrt(F.avg((F.col(label) - F.col("prediction")) ** 2))).first()[0])

    ref = rmse(base)
    rows = [(c, rmse(permute_column(base, c, seed + i, key)) - ref) for i, c in enumerate(features)]
    return spark.createDataFrame(rows, "feature string, importance double")
