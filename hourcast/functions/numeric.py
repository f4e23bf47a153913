"""Numeric coercion and rounding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def coerce_double(x) -> Column:
    """Unparsable -> NULL (ANSI mode makes plain casts throw); NaN -> NULL."""
    v = _c(x).try_cast("double")
    return F.nanvl(v, F.lit(None).cast("double"))


# relative nudge that absorbs summation-order noise (a few ulps) before rounding;
# never more than a thousandth of the last place kept, so large values keep their digits
STABLE_NUDGE = 1e-12


def round_stable(x, scale: int) -> Column:
    """Half away from zero, stable under summation order: a mean that is a decimal
    tie up to float noise rounds the same way on every partitioning/engine."""
    if isinstance(x, str):
        return F.expr(round_stable_text(f"`{x}`", scale))
    v = _c(x)
    nudge = F.least(F.abs(v) * F.lit(STABLE_NUDGE), F.lit(10.0 ** -(scale + 3)))
    return F.round(v + F.signum(v) * nudge, scale)


def round_stable_text(x: str, scale: int) -> str:
    """:func:`round_stable` of an SQL expression, as text: one call to the JVM builds it,
    where a wide frame would take a dozen for each column."""
    return f"round({x} + signum({x}) * least(abs({x}) * {STABLE_NUDGE!r}D, {10.0 ** -(scale + 3)!r}D), {scale})"


def round4(x) -> Column:
    """Documented rounding of window means (see :func:`round_stable`)."""
    return round_stable(x, 4)


def round_half_even(x, scale: int = 0) -> Column:
    return F.bround(_c(x), scale)


def r6(df: DataFrame) -> DataFrame:
    """Round every DOUBLE/FLOAT column to 6 places, tie-stable (see
    :func:`round_stable`), and fold -0.0 into 0.0 so results hash equal across
    engines and partitionings."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            text = f"{round_stable_text(f'`{f.name}`', 6)} + 0.0D"
            cols.append(f"CAST({text} AS FLOAT) AS `{f.name}`" if isinstance(f.dataType, T.FloatType) else f"{text} AS `{f.name}`")
        else:
            cols.append(f"`{f.name}`")
    return df.selectExpr(*cols) if cols else df
