"""Exploratory statistics as distributed aggregates: correlation matrices,
histograms, kernel density, box-plot statistics, normal Q-Q fit, bands."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourcast.operators.halo import PositionalPlan
from hourcast.operators.joins import join_small
from hourcast.operators.quantiles import quantiles_wide
from hourcast.schema import SERIES, TS
from hourcast.session import reliable_checkpoint

# ---- fixed values: rational approximation of the inverse normal CDF (Acklam) ---------------
INVNORM_A = [-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02,
             1.383577518672690e+02, -3.066479806614716e+01, 2.506628277459239e+00]
INVNORM_B = [-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02,
             6.680131188771972e+01, -1.328068155288572e+01]
INVNORM_C = [-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00,
             -2.549732539343734e+00, 4.374664141464968e+00, 2.938163982698783e+00]
INVNORM_D = [7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00, 3.754408661907416e+00]
INVNORM_P_LOW = 0.02425
# order-statistic medians of the normal probability plot (Filliben)
FILLIBEN_A = 0.3175
FILLIBEN_B = 0.365
# -----------------------------------------------------------------------------------------------


def _horner(coefs, x, lit, one_more: bool):
    acc = lit(coefs[0])
    for c in coefs[1:]:
        acc = acc * x + lit(c)
    if one_more:
        acc = acc * x + lit(1.0)
    return acc


def inv_norm(p: Column) -> Column:
    """Standard normal quantile as a native expression (|rel err| < 1.2e-9)."""
    lit = F.lit
    q_lo = F.sqrt(F.lit(-2.0) * F.log(p))
    q_hi = F.sqrt(F.lit(-2.0) * F.log(F.lit(1.0) - p))
    q = p - F.lit(0.5)
    r = q * q
    low = _horner(INVNORM_C, q_lo, lit, False) / _horner(INVNORM_D, q_lo, lit, True)
    high = -_horner(INVNORM_C, q_hi, lit, False) / _horner(INVNORM_D, q_hi, lit, True)
    mid = _horner(INVNORM_A, r, lit, False) * q / _horner(INVNORM_B, r, lit, True)
    return (F.when(p < INVNORM_P_LOW, low).when(p <= 1 - INVNORM_P_LOW, mid).otherwise(high))


def inv_norm_sql(p: str) -> str:
    def lit(c):
        return f"CAST('{c!r}' AS DOUBLE)"

    def horner(coefs, x, one_more):
        acc = lit(coefs[0])
        for c in coefs[1:]:
            acc = f"({acc} * {x} + {lit(c)})"
        if one_more:
            acc = f"({acc} * {x} + 1.0)"
        return acc
    qlo = f"sqrt(-2.0 * ln({p}))"
    qhi = f"sqrt(-2.0 * ln(1.0 - {p}))"
    q = f"({p} - 0.5)"
    r = f"({q} * {q})"
    low = f"({horner(INVNORM_C, qlo, False)} / {horner(INVNORM_D, qlo, True)})"
    high = f"(-{horner(INVNORM_C, qhi, False)} / {horner(INVNORM_D, qhi, True)})"
    mid = f"({horner(INVNORM_A, r, False)} * {q} / {horner(INVNORM_B, r, True)})"
    return f"CASE WHEN {p} < {INVNORM_P_LOW!r} THEN {low} WHEN {p} <= {1 - INVNORM_P_LOW!r} THEN {mid} ELSE {high} END"


def corr_matrix(df: DataFrame, columns) -> DataFrame:
    """Pearson correlation of every column pair (pairwise-complete rows), long form."""
    cols = [c for c in columns if c in df.columns]
    # corr is symmetric: aggregate the upper triangle once, emit both orders
    upper = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    agg = df.agg(*[F.corr(a, b).alias(f"{a}__{b}") for a, b in upper])
    name = {}
    for a, b in upper:
        name[(a, b)] = name[(b, a)] = f"{a}__{b}"
    pairs = [(a, b) for a in cols for b in cols]
    stack = ", ".join(f"'{a}', '{b}', `{name[(a, b)]}`" for a, b in pairs)
    return agg.selectExpr(f"stack({len(pairs)}, {stack}) AS (col_a, col_b, corr)")


def corr_with(df: DataFrame, target: str, columns, series=None) -> DataFrame:
    """Correlation of each column with ``target`` (long form)."""
    cols = [c for c in columns if c in df.columns and c != target]
    keys = [series] if series else []
    agg = df.groupBy(*keys).agg(*[F.corr(target, c).alias(c) for c in cols])
    stack = ", ".join(f"'{c}', `{c}`" for c in cols)
    return agg.selectExpr(*keys, f"stack({len(cols)}, {stack}) AS (feature, corr)")


def value_counts(df: DataFrame, value: str, series=SERIES) -> DataFrame:
    """(series, _x, _c): the distinct non-null values and their rows. A partial aggregate, so
    only distinct values meet the per-series parameters, however often one repeats."""
    v = df.select(series, F.col(value).alias("_x")).filter(F.col("_x").isNotNull())
    return v.groupBy(series, "_x").agg(F.count(F.lit(1)).alias("_c"))


def histogram(df: DataFrame, value: str, bins: int, series=SERIES) -> DataFrame:
    """Equal-width bins over [min, max] per series (last bin closed); every bin is
    emitted, empty ones with count 0. A range pass, then every row finds its bin against
    the small range table where it lies: only bin counts are shuffled."""
    v = df.select(series, F.col(value).alias("_x")).filter(F.col("_x").isNotNull())
    rng = reliable_checkpoint(v.groupBy(series).agg(F.min("_x").alias("_lo"), F.max("_x").alias("_hi")))
    idx = F.least(F.floor((F.col("_x") - F.col("_lo")) * F.lit(bins) / (F.col("_hi") - F.col("_lo"))),
                  F.lit(bins - 1))
    idx = F.when(F.col("_hi") > F.col("_lo"), idx).otherwise(F.lit(0)).cast("int")
    counts = join_small(v, rng, [series]).groupBy(series, idx.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    grid = rng.select(series, "_lo", "_hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    width = (F.col("_hi") - F.col("_lo")) / F.lit(bins)
    out = grid.join(counts, [series, "bin"], "left")
    return out.select(series, "bin", (F.col("_lo") + F.col("bin") * width).alias("bin_lo"),
                      (F.col("_lo") + (F.col("bin") + 1) * width).alias("bin_hi"),
                      F.coalesce("count", F.lit(0)).alias("count"))


KDE_CELL = 0.5    # width of a cell, in bandwidths
KDE_TERMS = 14    # moments kept of each cell


def kde(df: DataFrame, value: str, grid: int = 200, cut: float = 3.0, series=SERIES) -> DataFrame:
    """Gaussian kernel density on ``grid`` points over [min - cut*h, max + cut*h]
    with Scott's bandwidth h = std * n^(-1/5), by a fast Gauss transform.

    Rows collapse map-side into cells half a bandwidth wide: with u = (x - centre) / h a cell keeps
    the sums of u^k. The density at t = (g - centre) / h is exp(-t^2 / 2) times the sum over
    k of He_k(t) sum(u^k) / k! (Hermite's generating function), cut after ``KDE_TERMS``
    terms: with |u| <= 1/4 the rest is below 1e-13 of the kernel's peak. Only cells meet
    the grid; there are about range / h of them, however many rows. A series without
    spread has null densities."""
    v = df.select(series, F.col(value).alias("_x")).filter(F.col("_x").isNotNull())
    p = v.groupBy(series).agg(F.count(F.lit(1)).alias("_n"), F.stddev_samp("_x").alias("_sd"),
                              F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
    p = p.withColumn("_h", F.col("_sd") * F.pow(F.col("_n").cast("double"), F.lit(-0.2)))
    p = reliable_checkpoint(p.select(
        series, "_n", "_lo", F.when(F.col("_h") > 0, F.col("_h")).alias("_h"), (F.col("_lo") - cut * F.col("_h")).alias("_g0"),
        ((F.col("_hi") - F.col("_lo") + 2 * cut * F.col("_h")) / F.lit(grid - 1)).alias("_gs")))
    at = (F.col("_x") - F.col("_lo")) / F.col("_h") / KDE_CELL
    rows = join_small(v, p.select(series, "_lo", "_h"), [series]).select(series, F.floor(at).alias("_cell"), at.alias("_at"))
    rows = rows.select(series, "_cell", ((F.col("_at") - F.col("_cell") - 0.5) * KDE_CELL).alias("_u"))
    power, moments = F.lit(1.0), []
    for k in range(KDE_TERMS):
        moments.append(F.sum(power / math.factorial(k)).alias(f"_m{k}"))
        power = power * F.col("_u")
    cells = rows.groupBy(series, "_cell").agg(*moments).join(p, series)
    cells = cells.withColumn("gi", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))))
    g = F.col("_g0") + F.col("gi") * F.col("_gs")
    cells = cells.withColumn("_t", (g - F.col("_lo")) / F.col("_h") - (F.col("_cell") + 0.5) * KDE_CELL)
    t, total = F.col("_t"), F.lit(0.0)
    # He_(k+1)(t) = t He_k(t) - k He_(k-1)(t), as a list built along the row
    he = F.array(F.lit(1.0), t)
    for k in range(1, KDE_TERMS - 1):
        cells = cells.withColumn("_he", he)
        he = F.concat("_he", F.array(t * F.col("_he")[k] - k * F.col("_he")[k - 1]))
    cells = cells.withColumn("_he", he)
    for k in range(KDE_TERMS):
        total = total + F.col("_he")[k] * F.col(f"_m{k}")
    sums = cells.groupBy(series, "gi").agg(F.sum(F.exp(F.lit(-0.5) * t * t) * total).alias("_s"))
    out = sums.join(p, series)
    return out.select(series, "gi", (F.col("_g0") + F.col("gi") * F.col("_gs")).alias("x"),
                      (F.col("_s") / (F.col("_n") * F.col("_h") * F.lit(math.sqrt(2 * math.pi)))).alias("density"))


def boxplot_stats(df: DataFrame, value: str, series=SERIES, whis: float = 1.5) -> DataFrame:
    """Quartiles, whiskers and number of fliers per series: the quartiles' two passes, and
    one in which rows meet the small quartile table where they lie."""
    v = df.select(series, F.col(value).alias("_x")).filter(F.col("_x").isNotNull())
    q = reliable_checkpoint(quantiles_wide(v, [series], "_x", [0.25, 0.5, 0.75], ["q1", "median", "q3"]))
    iqr = F.col("q3") - F.col("q1")
    lo_f, hi_f = F.col("q1") - whis * iqr, F.col("q3") + whis * iqr
    return join_small(v, q, [series]).groupBy(series, "q1", "median", "q3").agg(
        F.min(F.when(F.col("_x") >= lo_f, F.col("_x"))).alias("whisker_lo"),
        F.max(F.when(F.col("_x") <= hi_f, F.col("_x"))).alias("whisker_hi"),
        F.sum(F.when((F.col("_x") < lo_f) | (F.col("_x") > hi_f), F.lit(1)).otherwise(0)).alias("n_fliers"),
    ).withColumn("iqr", iqr)


def value_buckets(counts: DataFrame, series=SERIES, bucket_count: int = 256) -> DataFrame:
    """Distinct values with ``_n`` (rows of the series) and ``_bk``, a bucket that grows with the
    value. Bounds are approximate quantiles of the distinct values (a mergeable sketch), so an
    outlier stretches no bucket; the bounds decide only which task ranks a value."""
    at = [i / bucket_count for i in range(1, bucket_count)]
    bounds = counts.groupBy(series).agg(F.sum("_c").alias("_n"), F.percentile_approx("_x", at, 10000).alias("_b"))
    below = F.size(F.filter("_b", lambda b: b < F.col("_x")))
    return counts.join(bounds, series).withColumn("_bk", below).drop("_b")


RANK_SPLIT = 1_000_000  # ranks expanded per task for one repeated value


def qq_fit(df: DataFrame, value: str, series=SERIES, bucket_count: int = 256) -> DataFrame:
    """Normal probability plot fit: sorted sample against normal order-statistic
    medians; slope, intercept, r.

    Ranks are assigned to *distinct values*: value counts are a partial
    aggregate (a value repeated by a third of all rows is combined map-side),
    prefix sums over the distinct values come from value-bucketed positions
    (``value_buckets``: equal numbers of distinct values, wherever they lie), and each value's rank range is cut into sub-ranges of at most
    ``RANK_SPLIT`` ranks that are spread over tasks before being expanded."""
    counts = value_counts(df, value, series)
    # start rank of each distinct value = rows before it: positions over the distinct
    # values, weighted by their counts (prefix sums of bucket totals + in-bucket sums)
    staged = value_buckets(counts, series, bucket_count)
    wb = Window.partitionBy(series, "_bk").orderBy("_x").rowsBetween(Window.unboundedPreceding, -1)
    staged = staged.withColumn("_inb", F.coalesce(F.sum("_c").over(wb), F.lit(0)))
    tot = staged.groupBy(series, "_bk").agg(F.sum("_c").alias("_t"))
    wt = Window.partitionBy(series).orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    off = tot.select(series, "_bk", F.coalesce(F.sum("_t").over(wt), F.lit(0)).alias("_off"))
    ranged = staged.join(off, [series, "_bk"]).withColumn("_a", F.col("_off") + F.col("_inb") + 1)
    # split each rank range [a, a + c - 1] into pieces of at most RANK_SPLIT ranks
    pieces = ranged.withColumn("_p", F.explode(F.sequence(F.lit(0), F.floor((F.col("_c") - 1) / F.lit(RANK_SPLIT)))))
    pieces = pieces.withColumns({
        "_s": F.col("_a") + F.col("_p") * F.lit(RANK_SPLIT),
        "_e": F.least(F.col("_a") + F.col("_c") - 1, F.col("_a") + (F.col("_p") + 1) * F.lit(RANK_SPLIT) - 1),
    }).repartition(series, "_x", "_p")
    ranks = pieces.select(series, "_x", "_n", F.explode(F.sequence(F.col("_s"), F.col("_e"))).alias("_i"))
    n = F.col("_n").cast("double")
    m = (F.col("_i") - FILLIBEN_A) / (n + FILLIBEN_B)
    m = F.when(F.col("_i") == 1, F.lit(1.0) - F.pow(F.lit(0.5), F.lit(1.0) / n)) \
        .when(F.col("_i") == F.col("_n"), F.pow(F.lit(0.5), F.lit(1.0) / n)).otherwise(m)
    pts = ranks.withColumn("osm", inv_norm(m))
    return pts.groupBy(series).agg(
        F.count(F.lit(1)).alias("n"),
        F.regr_slope("_x", "osm").alias("slope"),
        F.regr_intercept("_x", "osm").alias("intercept"),
        F.corr("osm", "_x").alias("r"),
    ).withColumn("r2", F.col("r") * F.col("r"))


def mean_std_band(prof: DataFrame) -> DataFrame:
    return prof.withColumns({"lower": F.col("mean") - F.col("std"), "upper": F.col("mean") + F.col("std")})


def rolling_band(df: DataFrame) -> DataFrame:
    return df.withColumns({"lower": F.col("rolling_mean_24h") - F.col("rolling_std_24h"),
                           "upper": F.col("rolling_mean_24h") + F.col("rolling_std_24h")})


def sequence_scaler(df: DataFrame, feat_cols, target: str, lookback: int = 24, series=SERIES, ts=TS, strategy=None) -> DataFrame:
    """feature_index, mean and population std (0 -> 1) of each feature over all cells of the
    sequences of :func:`hourcast.operators.windows.sequences`, without making them: a row
    counts once for each valid window that holds it, and the windows that end at the row or
    up to ``lookback - 1`` rows later are counted by a frame over their validity. Mean and
    spread are weighted aggregates of the rows, in two passes."""
    keys = [series] if isinstance(series, str) else list(series)
    plan = PositionalPlan(df, keys, ts, lookback=lookback - 1, lookahead=lookback - 1, strategy=strategy)
    back = plan.window.rowsBetween(-(lookback - 1), 0)
    holes = F.sum(F.when(F.greatest(*[F.col(c).isNull().cast("int") for c in [feat_cols[0], *feat_cols]]) > 0, 1).otherwise(0)).over(back)
    valid = (F.count(F.lit(1)).over(back) == lookback) & (holes == 0) & F.col(target).isNotNull()
    staged = plan.df.withColumn("_ends", valid.cast("long"))
    staged = staged.withColumn("_w", F.sum("_ends").over(plan.window.rowsBetween(0, lookback - 1)))
    rows = plan.finish(staged).filter(F.col("_w") > 0)
    rows = reliable_checkpoint(rows.select("_w", *[F.col(c).cast("float").cast("double").alias(f"_f{i}") for i, c in enumerate(feat_cols)]))
    n = len(feat_cols)
    means = rows.agg(F.sum("_w").alias("_n"), *[(F.sum(F.col("_w") * F.col(f"_f{i}")) / F.sum("_w")).alias(f"_m{i}") for i in range(n)])
    spread = join_small(rows, reliable_checkpoint(means), []).groupBy("_n", *[f"_m{i}" for i in range(n)]).agg(
        *[F.sqrt(F.sum(F.col("_w") * F.pow(F.col(f"_f{i}") - F.col(f"_m{i}"), F.lit(2.0))) / F.col("_n")).alias(f"_s{i}") for i in range(n)])
    each = spread.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("feature_index"), F.col(f"_m{i}").alias("mean"), F.col(f"_s{i}").alias("sd")) for i in range(n)])).alias("e"))
    return each.select("e.feature_index", "e.mean", F.when(F.col("e.sd") == 0, F.lit(1.0)).otherwise(F.col("e.sd")).alias("scale"))


def corr_pairs(df: DataFrame, columns) -> DataFrame:
    """col_a, col_b, corr of every pair of columns (a before or equal to b), over the rows that
    have both; NULL where one of them does not vary. For wide frames: a task adds up the
    co-moments of all pairs with matrix products, about the columns' means, and emits a row per
    pair."""
    cols = list(columns)
    data = df.select(*[F.col(c).cast("double").alias(f"_c{i}") for i, c in enumerate(cols)])
    first = data.agg(*[F.avg(f"_c{i}").alias(f"_c{i}") for i in range(len(cols))]).first()
    centre = np.array([v if v is not None else 0.0 for v in first])
    names = ["i", "j", "n", "sx", "sy", "sxx", "syy", "sxy"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((6, len(cols), len(cols)))
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.column_stack([c.fill_null(float("nan")).to_numpy(zero_copy_only=False) for c in batch.columns]) - centre
            m = (~np.isnan(x)).astype(float)
            x = np.nan_to_num(x, nan=0.0)
            total += np.stack([m.T @ m, x.T @ m, m.T @ x, (x * x).T @ m, m.T @ (x * x), x.T @ x])
        i, j = np.triu_indices(len(cols))
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), *[pa.array(t[i, j]) for t in total]], names=names)

    part = data.mapInArrow(run, "i int, j int, " + ", ".join(f"{c} double" for c in names[2:]))
    s = part.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in names[2:]])
    vx, vy = F.col("sxx") - F.col("sx") ** 2 / F.col("n"), F.col("syy") - F.col("sy") ** 2 / F.col("n")
    cov = F.col("sxy") - F.col("sx") * F.col("sy") / F.col("n")
    # Rounding leaves a constant column a spread of some last places.
    varies = (F.col("n") > 1) & (vx > 1e-12 * F.col("sxx")) & (vy > 1e-12 * F.col("syy"))
    label = F.array(*[F.lit(c) for c in cols])
    return s.select(F.element_at(label, F.col("i") + 1).alias("col_a"), F.element_at(label, F.col("j") + 1).alias("col_b"),
                    F.when(varies, cov / F.sqrt(vx * vy)).alias("corr"))
