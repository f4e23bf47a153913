"""Row-positional window features over hourly series (lags, rolling stats,
gaps, exact-horizon targets, back-fill, forward fill, splits, sequences).

All features of one stage share one ``partitionBy(series).orderBy(ts)`` spec,
so Catalyst plans a single exchange + sort + Window for the whole stage. With
``strategy="halo"`` the same expressions run over chunk-with-halo partitions
(see :mod:`hourcast.operators.halo`) so one hot series is never one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourcast.functions.calendar import add_calendar, add_cyclical, hours_between
from hourcast.operators.halo import PositionalPlan
from hourcast.schema import (FEATURE_COLUMNS, LAG_COLUMNS, LAG_HOURS, ROLLING_COLUMNS, ROLLING_WINDOWS,
                             SERIES, SHIFT_BACKFILL_SOURCES, TS, ZERO_BACKFILL_COLUMNS, target_column)

UNBOUNDED = Window.unboundedPreceding


def series_window(series=SERIES, ts=TS) -> Window:
    keys = [series] if isinstance(series, str) else list(series)
    return Window.partitionBy(*keys).orderBy(ts)


def gap_columns(w: Window, ts=TS) -> dict[str, Column]:
    gap = F.coalesce(hours_between(F.col(ts), F.lag(ts, 1).over(w)), F.lit(0.0))
    return {"hours_since_prev": gap.cast("float"), "is_gap": (gap > 1.0).cast("byte")}


def lag_columns(w: Window, value="aqi", lags=LAG_HOURS) -> dict[str, Column]:
    return {f"{value}_lag_{n}h": F.lag(value, n).over(w) for n in lags}


def rolling_columns(w: Window, value="aqi", windows=ROLLING_WINDOWS) -> dict[str, Column]:
    cols = {}
    for n in windows:
        cols[f"rolling_mean_{n}h"] = F.avg(value).over(w.rowsBetween(-(n - 1), 0))
    for n in windows:
        cols[f"rolling_std_{n}h"] = F.stddev_samp(value).over(w.rowsBetween(-(n - 1), 0))
    return cols


def add_gap_features(df: DataFrame, series=SERIES, ts=TS, strategy=None) -> DataFrame:
    plan = PositionalPlan(df, series, ts, lookback=1, strategy=strategy)
    return plan.finish(plan.df.withColumns(gap_columns(plan.window, ts)))


def add_lags(df: DataFrame, value="aqi", lags=LAG_HOURS, series=SERIES, ts=TS, strategy=None) -> DataFrame:
    plan = PositionalPlan(df, series, ts, lookback=max(lags), strategy=strategy)
    return plan.finish(plan.df.withColumns(lag_columns(plan.window, value, lags)))


def add_rolling(df: DataFrame, value="aqi", windows=ROLLING_WINDOWS, series=SERIES, ts=TS,
                strategy=None) -> DataFrame:
    plan = PositionalPlan(df, series, ts, lookback=max(windows) - 1, strategy=strategy)
    return plan.finish(plan.df.withColumns(rolling_columns(plan.window, value, windows)))


def add_engineered_features(df: DataFrame, series=SERIES, ts=TS, strategy=None) -> DataFrame:
    """Calendar + cyclical + gap + lag + rolling features in one window stage.
    Without an ``aqi`` column the lag/rolling columns are NULL."""
    data = add_cyclical(add_calendar(df, ts))
    reach = max(max(LAG_HOURS), max(ROLLING_WINDOWS) - 1)
    plan = PositionalPlan(data, series, ts, lookback=reach, strategy=strategy)
    cols = gap_columns(plan.window, ts)
    if "aqi" in df.columns:
        cols.update(lag_columns(plan.window, "aqi"))
        cols.update(rolling_columns(plan.window, "aqi"))
    else:
        cols.update({c: F.lit(None).cast("double") for c in LAG_COLUMNS + ROLLING_COLUMNS})
    return plan.finish(plan.df.withColumns(cols))


def build_training_frame(df: DataFrame, horizon_hours: int, series=SERIES, ts=TS,
                         strategy=None) -> DataFrame:
    """Target ``aqi_next_{h}h`` = aqi ``h`` rows later, kept only when that row is
    exactly ``h`` hours later. Stored lag/rolling columns are not recomputed
    (absent -> NULL); calendar and gap columns are derived only when absent."""
    data = add_cyclical(add_calendar(df, ts, only_missing=True), only_missing=True)
    for c in LAG_COLUMNS + ROLLING_COLUMNS:
        if c not in data.columns:
            data = data.withColumn(c, F.lit(None).cast("double"))
    need_gap = "hours_since_prev" not in df.columns or "is_gap" not in df.columns
    plan = PositionalPlan(data, series, ts, lookback=1 if need_gap else 0, lookahead=horizon_hours,
                          strategy=strategy)
    w = plan.window
    cols = {}
    if need_gap:
        g = gap_columns(w, ts)
        cols.update({k: v for k, v in g.items() if k not in df.columns})
    tgt = target_column(horizon_hours)
    cols[tgt] = F.lead("aqi", horizon_hours).over(w)
    cols["_target_ts"] = F.lead(ts, horizon_hours).over(w)
    staged = plan.df.withColumns(cols)
    kept = staged.filter(hours_between(F.col("_target_ts"), F.col(ts)) == float(horizon_hours))
    return plan.finish(kept.drop("_target_ts"))


def exact_horizon_recheck(df: DataFrame, horizon_hours: int, series=SERIES, ts=TS, strategy=None) -> DataFrame:
    """Re-apply the positional exact-horizon test on an already filtered frame."""
    plan = PositionalPlan(df, series, ts, lookahead=horizon_hours, lookback=0, strategy=strategy)
    staged = plan.df.withColumn("_t2", F.lead(ts, horizon_hours).over(plan.window))
    kept = staged.filter(hours_between(F.col("_t2"), F.col(ts)) == float(horizon_hours)).drop("_t2")
    return plan.finish(kept)


def shifted_backfill(df: DataFrame, series=SERIES, ts=TS, strategy=None) -> DataFrame:
    """Missing ``fc_{x}_{h}`` <- observed ``x`` h rows later; dust/uvi <- 0.0."""
    plan = PositionalPlan(df, series, ts, lookahead=72, lookback=0, strategy=strategy)
    w = plan.window
    cols = {}
    for label, h in (("24h", 24), ("48h", 48), ("72h", 72)):
        for fc, src in SHIFT_BACKFILL_SOURCES:
            key = f"{fc}_{label}"
            cols[key] = F.coalesce(F.col(key), F.lead(src, h).over(w))
        for fc in ZERO_BACKFILL_COLUMNS:
            key = f"{fc}_{label}"
            cols[key] = F.coalesce(F.col(key), F.lit(0.0))
    return plan.finish(plan.df.withColumns(cols))


def forward_fill(df: DataFrame, columns, partition=(SERIES,), ts=TS, fill: float = 0.0,
                 strategy: str | None = None) -> DataFrame:
    """Per column: last non-null value so far in the partition, then ``fill``.

    ``halo``: chunk-local forward fill, plus the last non-null value of every
    earlier chunk (a window over the per-chunk table, one row per chunk)."""
    from hourcast.operators.halo import CHUNK, RN, carry_last, chunk_index, resolve_strategy
    cols = [c for c in columns if c in df.columns]
    keys = list(partition)
    if not cols:
        return df
    halo = resolve_strategy(strategy)
    if halo is None:
        w = Window.partitionBy(*keys).orderBy(ts).rowsBetween(UNBOUNDED, 0)
        return df.withColumns({c: F.coalesce(F.last(c, ignorenulls=True).over(w),
                                             F.lit(fill).cast(df.schema[c].dataType)) for c in cols})
    staged = chunk_index(df, keys, ts, halo.chunk_rows, halo.bucket_seconds)
    w = Window.partitionBy(*keys, CHUNK).orderBy(RN).rowsBetween(UNBOUNDED, 0)
    local = staged.withColumns({f"_loc_{c}": F.last(c, ignorenulls=True).over(w) for c in cols})
    summary = staged.groupBy(*keys, CHUNK).agg(*[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(RN)))
                                                 .alias(f"_end_{c}") for c in cols])
    carry = carry_last(summary, keys, cols)
    out = local.join(carry, [*keys, CHUNK], "left")
    out = out.withColumns({c: F.coalesce(F.col(f"_loc_{c}"), F.col(f"_in_{c}"),
                                         F.lit(fill)).cast(df.schema[c].dataType) for c in cols})
    return out.drop(RN, CHUNK, *[f"_loc_{c}" for c in cols], *[f"_in_{c}" for c in cols])


def chronological_split(df: DataFrame, fraction: float = 0.8, series=SERIES, ts=TS,
                        column: str = "split", strategy: str | None = None) -> DataFrame:
    """First ``int(fraction * n)`` rows of each series -> 'train', rest -> 'test'.

    ``plain``: count and row_number windows per series. ``halo``: positions from
    time buckets (:func:`hourcast.operators.halo.positions`) and per-series
    counts from a grouped aggregate (one row per series), so no task ever holds
    a whole series."""
    from hourcast.operators.halo import RN, positions
    from hourcast.operators.halo import resolve_strategy
    keys = [series] if isinstance(series, str) else list(series)
    halo = resolve_strategy(strategy)
    if halo is not None:
        pos = positions(df, keys, ts, halo.bucket_seconds)
        n = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        out = pos.join(n, keys)
        label = F.when(F.col(RN) <= F.floor(F.col("_n") * F.lit(fraction)), F.lit("train")).otherwise(F.lit("test"))
        return out.withColumn(column, label).drop(RN, "_n")
    w = Window.partitionBy(*keys).orderBy(ts)
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    rn = F.row_number().over(w)
    return df.withColumn(column, F.when(rn <= F.floor(n * F.lit(fraction)), F.lit("train")).otherwise(F.lit("test")))


def cumulative_gap_share(df: DataFrame, series=SERIES, ts=TS, strategy: str | None = None) -> DataFrame:
    """Per step between consecutive rows: running share (%) of exact 1 h steps.

    ``halo``: gaps from a 1-row halo, running counts chunk-locally plus the
    total of all earlier chunks (window over the per-chunk table)."""
    from hourcast.operators.halo import CHUNK, RN, carry_sum, resolve_strategy
    one = (F.col("gap_hours") == 1.0).cast("long")
    if resolve_strategy(strategy) is None:
        w = series_window(series, ts)
        step = df.withColumn("gap_hours", hours_between(F.col(ts), F.lag(ts, 1).over(w))) \
            .filter(F.col("gap_hours").isNotNull())
        return step.withColumns({
            "step": F.row_number().over(w).cast("long"),
            "cum_one_hour_pct": F.sum(one).over(w.rowsBetween(UNBOUNDED, 0)) * 100.0 / F.row_number().over(w),
        })
    keys = [series] if isinstance(series, str) else list(series)
    plan = PositionalPlan(df, keys, ts, lookback=1, strategy=strategy)
    g = plan.finish(plan.df.withColumn("gap_hours", hours_between(F.col(ts), F.lag(ts, 1).over(plan.window))),
                    keep_position=True)
    g = g.withColumn(CHUNK, F.floor((F.col(RN) - 1) / F.lit(plan.chunk_rows)))
    w = Window.partitionBy(*keys, CHUNK).orderBy(RN).rowsBetween(UNBOUNDED, 0)
    local = g.withColumn("_loc", F.sum(F.coalesce(one, F.lit(0))).over(w))
    summary = g.groupBy(*keys, CHUNK).agg(F.sum(F.coalesce(one, F.lit(0))).alias("_tot_n"))
    out = local.join(carry_sum(summary, keys, ["n"]), [*keys, CHUNK], "left")
    out = out.filter(F.col("gap_hours").isNotNull()).withColumns({
        "step": (F.col(RN) - 1).cast("long"),
        "cum_one_hour_pct": (F.col("_loc") + F.coalesce("_in_n", F.lit(0))) * 100.0 / (F.col(RN) - 1),
    })
    return out.drop(RN, CHUNK, "_loc", "_in_n")


def sequences(df: DataFrame, feat_cols, target: str, lookback: int = 24, series=SERIES, ts=TS,
              partition_extra=(), strategy: str | None = None) -> DataFrame:
    """``lookback``-row sliding windows of the feature vectors ending at each row;
    dropped when the window is short, holds a NULL feature or the target is NULL."""
    keys = ([series] if isinstance(series, str) else list(series)) + list(partition_extra)
    plan = PositionalPlan(df, keys, ts, lookback=lookback - 1, strategy=strategy)
    w = plan.window.rowsBetween(-(lookback - 1), 0)
    vec = F.array(*[F.col(c).cast("float") for c in feat_cols])
    row_has_null = F.greatest(*[F.col(c).isNull().cast("int") for c in feat_cols]) if len(feat_cols) > 1 \
        else F.col(feat_cols[0]).isNull().cast("int")
    staged = plan.df.withColumns({
        "x": F.collect_list(vec).over(w),
        "_nulls": F.sum(row_has_null).over(w),
        "_len": F.count(F.lit(1)).over(w),
    })
    kept = plan.finish(staged.filter((F.col("_len") == lookback) & (F.col("_nulls") == 0) & F.col(target).isNotNull()))
    return kept.select(*keys, ts, "x", F.col(target).cast("float").alias("y"))


def latest_per_series(df: DataFrame, n: int = 1, series=SERIES, ts=TS) -> DataFrame:
    """Newest ``n`` rows of each series (planned as WindowGroupLimit)."""
    keys = [series] if isinstance(series, str) else list(series)
    w = Window.partitionBy(*keys).orderBy(F.col(ts).desc())
    return df.withColumn("_rk", F.row_number().over(w)).filter(F.col("_rk") <= n).drop("_rk")


def append_row_features(history: DataFrame, current: DataFrame, series=SERIES, ts=TS, rows: int = 50) -> DataFrame:
    """Newest ``rows`` history rows of each series (then those with an aqi) + current
    readings -> features -> newest row per series (which need not be the current row)."""
    hist = latest_per_series(history, rows, series, ts)
    hist = hist.filter(F.col("aqi").isNotNull()) if "aqi" in history.columns else hist
    combined = hist.unionByName(current, allowMissingColumns=True)
    feats = add_engineered_features(combined, series, ts)
    return latest_per_series(feats, 1, series, ts)


def prediction_frame(df: DataFrame, series=SERIES, ts=TS, strategy=None) -> DataFrame:
    """Features recomputed over the slice, then forward fill + 0 on the feature
    columns only (forecast columns untouched)."""
    feats = add_engineered_features(df, series, ts, strategy=strategy)
    cols = [c for c in FEATURE_COLUMNS if c in feats.columns]
    return forward_fill(feats, cols, partition=(series,), ts=ts, strategy=strategy)
