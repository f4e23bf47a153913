"""Joins over hourly series: time equi-joins, lookups, the forecast range
aggregate, anti/semi joins and union by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourcast.functions.numeric import round_stable_text
from hourcast.schema import FORECAST_COLUMNS, FORECAST_WINDOWS, SERIES, TS

DEFAULT_BUCKET_SECONDS = 7 * 86400
BROADCAST_ROWS = 1 << 17  # groups whose few parameters may be broadcast


def join_small(rows: DataFrame, small: DataFrame, keys, how: str = "inner") -> DataFrame:
    """``rows`` with the parameters of their group. ``small`` is already computed and has a
    row per group; it is counted, and broadcast up to ``BROADCAST_ROWS`` rows. Beyond that
    the join is left to the planner."""
    keys = list(keys)
    if not keys:  # one group: one row
        return rows.join(F.broadcast(small.limit(1)), F.lit(True), how)
    fits = small.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    renamed = small.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[c for c in small.columns if c not in keys])
    same = [rows[k].eqNullSafe(renamed[f"_k_{k}"]) for k in keys]
    return rows.join(F.broadcast(renamed) if fits else renamed, same, how).drop(*[f"_k_{k}" for k in keys])


def join_on_time(left: DataFrame, right: DataFrame, how: str = "inner", series=SERIES, ts=TS) -> DataFrame:
    """Equi-join on (series, timestamp). Both sides are usually aggregates already
    hash-partitioned on these keys, so no extra exchange is planned; AQE turns
    it into a broadcast join when one side measures small at run time."""
    keys = ([series] if isinstance(series, str) else list(series)) + [ts]
    return left.join(right, keys, how)


def anti_join_new(new: DataFrame, existing: DataFrame, keys=(SERIES, TS)) -> DataFrame:
    """Rows of ``new`` whose key is not stored yet (idempotent-append filter)."""
    return new.join(existing.select(*keys), list(keys), "left_anti")


def semi_join(df: DataFrame, other: DataFrame, keys) -> DataFrame:
    return df.join(other.select(*keys), list(keys), "left_semi")


def union_by_name(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def forecast_windows(base: DataFrame, forecast: DataFrame, series=SERIES, ts=TS,
                     windows=FORECAST_WINDOWS, columns=FORECAST_COLUMNS, decimals: int | None = 4,
                     bucket_seconds: int = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    """For every base row and each window [h0, h1) hours ahead: mean of each
    forecast column over the forecast rows of the same series inside the
    window (rounded), NULL when the window is empty or all NULL.

    Planned without a join: base and forecast rows are unioned and sorted once by
    (series, time bucket). Every row carries the running count and sum of the forecast rows up
    to it; for each edge of the windows (0, 24, 48, 72 hours ahead) a growing frame finds the
    last of them before the edge, and a window's mean is the difference of two edges. Both
    are kept up row by row, so a row costs four edges whatever the windows' length.
    Sums are decimals of 12 places: differences are exact (a value that has none, NaN or beyond 10^16, counts as missing).

    To bound task size for a hot series the union is partitioned by (series, time bucket);
    forecast rows are copied into the buckets whose base rows can reach them
    (1 + ceil(max_reach / bucket) copies), base rows are never copied."""
    keys = [series] if isinstance(series, str) else list(series)
    max_reach = max(h1 for _, _, h1 in windows) * 3600
    copies = 1 + -(-max_reach // bucket_seconds)
    fc_cols = [c for c in columns if c in forecast.columns]
    epoch = F.unix_seconds(F.col(ts).cast("timestamp"))
    bucket = F.floor(epoch / F.lit(bucket_seconds))
    b = base.select("*", epoch.alias("_e"), bucket.alias("_bk"), F.lit(True).alias("_base"))
    # forecast values live under one private name so base columns never collide
    values = F.expr("named_struct(" + ", ".join(f"'{c}', try_cast(CAST(`{c}` AS DOUBLE) AS DECIMAL(28, 12))" for c in fc_cols) + ")")
    f = forecast.select(*keys, epoch.alias("_e"), F.explode(F.sequence(bucket - (copies - 1), bucket)).alias("_bk"), F.lit(False).alias("_base"),
                        values.alias("_fv"))
    u = b.unionByName(f, allowMissingColumns=True)
    w = Window.partitionBy(*keys, "_bk").orderBy("_e")
    edges = sorted({h for _, h0, h1 in windows for h in (h0, h1)})
    own = [c for c in base.columns if c not in {f"{c}_{label}" for label, _, _ in windows for c in columns}]
    # running sums and counts up to each row, then the last of them before each edge
    over = f"OVER (PARTITION BY {', '.join(f'`{k}`' for k in keys)}, _bk ORDER BY _e ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    prefix = F.expr("named_struct(" + ", ".join(
        f"'s_{c}', sum(_fv.`{c}`) {over}, 'n_{c}', count(_fv.`{c}`) {over}" for c in fc_cols) + ")") if fc_cols else None
    staged = u.select(*own, "_base", "_e", "_bk", prefix.alias("_p")) if fc_cols else u
    staged = staged.select(*own, "_base", *[F.last("_p").over(w.rangeBetween(Window.unboundedPreceding, h * 3600 - 1)).alias(f"_p{h}")
                                            for h in edges if fc_cols]).filter("_base")

    def mean(c: str, h0: int, h1: int) -> str:
        n = f"(_p{h1}.`n_{c}` - coalesce(_p{h0}.`n_{c}`, 0L))"
        total = f"CAST(_p{h1}.`s_{c}` - coalesce(_p{h0}.`s_{c}`, CAST(0 AS DECIMAL(38, 12))) AS DOUBLE)"
        return f"CASE WHEN {n} > 0 THEN {total} / {n} END"

    names = {f"{c}_{label}": (c, h0, h1) for label, h0, h1 in windows for c in columns}
    out = staged.selectExpr(*[f"`{c}`" for c in own], *[
        f"{mean(c, h0, h1) if c in fc_cols else 'CAST(NULL AS DOUBLE)'} AS `{name}`" for name, (c, h0, h1) in names.items()])
    if decimals is None:
        return out
    return out.selectExpr(*[f"`{c}`" for c in own], *[f"{round_stable_text(f'`{n}`', decimals)} AS `{n}`" for n in names])


def forecast_windows_for_latest(base: DataFrame, forecast: DataFrame, series=SERIES, ts=TS) -> DataFrame:
    """Single-timestamp variant: windows for the newest row of each series."""
    latest = base.groupBy(series).agg(F.max(ts).alias(ts))
    return forecast_windows(latest, forecast, series, ts)
