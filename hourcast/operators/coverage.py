"""Coverage-gated feature lists: one aggregate pass, decision on the driver
(the driver only ever sees one row of per-column fractions)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourcast.schema import (BASE_FEATURE_COLS, COVERAGE_THRESHOLD, FORECAST_BASE_FEATURES, HORIZON_FORECAST_WINDOWS,
                             HORIZON_LAG_COLS, HORIZON_ROLLING_COLS, ordered_unique)


def coverage_frame(df: DataFrame, columns) -> DataFrame:
    """Long form: column, coverage (non-null fraction over all rows)."""
    cols = [c for c in columns if c in df.columns]
    agg = df.agg(*[F.avg(F.col(c).isNotNull().cast("double")).alias(c) for c in cols])
    stack = ", ".join(f"'{c}', `{c}`" for c in cols)
    return agg.selectExpr(f"stack({len(cols)}, {stack}) AS (column, coverage)")


def horizon_candidates(horizon_hours: int) -> tuple[list[str], list[str]]:
    base = BASE_FEATURE_COLS + HORIZON_LAG_COLS[horizon_hours] + HORIZON_ROLLING_COLS[horizon_hours]
    fc = [f"{b}_{w}" for w in HORIZON_FORECAST_WINDOWS.get(horizon_hours, []) for b in FORECAST_BASE_FEATURES]
    return ordered_unique(base + fc), fc


def horizon_feature_cols(df: DataFrame, horizon_hours: int, threshold: float = COVERAGE_THRESHOLD) -> list[str]:
    """Base + lag + rolling columns present in ``df``; forecast columns only when
    their coverage reaches ``threshold``."""
    cands, fc = horizon_candidates(horizon_hours)
    present_fc = [c for c in fc if c in df.columns]
    cov = {}
    if present_fc:
        row = df.agg(*[F.avg(F.col(c).isNotNull().cast("double")).alias(c) for c in present_fc]).first()
        cov = row.asDict() if row is not None else {}
    out = []
    for c in cands:
        if c not in df.columns:
            continue
        if c in fc:
            if (cov.get(c) or 0.0) >= threshold:
                out.append(c)
        else:
            out.append(c)
    return out


def coverage_decisions(df: DataFrame, horizon_hours: int, threshold: float = COVERAGE_THRESHOLD) -> DataFrame:
    """Same gate as :func:`horizon_feature_cols`, as a DataFrame (no driver hop)."""
    _, fc = horizon_candidates(horizon_hours)
    cov = coverage_frame(df, fc)
    return cov.select(F.lit(horizon_hours).alias("horizon"), F.col("column").alias("feature"), "coverage",
                      (F.col("coverage") >= threshold).alias("kept"))


def rows_with_any(df: DataFrame, columns) -> DataFrame:
    cols = [c for c in columns if c in df.columns]
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.count_if(F.coalesce(*[F.col(c) for c in cols]).isNotNull()).alias("rows_with_forecast"))
