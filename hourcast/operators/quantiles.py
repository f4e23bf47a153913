"""Exact quantiles (linear interpolation between order statistics, the
``quantile_cont`` / pandas default) in two passes over the rows.

1. A mergeable rank sketch of every column brackets all targets at once: the values
   at ranks safely below and above each target (the sketch's rank error is at most
   rows / ``ACCURACY``; the brackets leave three times that).
2. Every value is counted: in a bracket under its own value, outside under the gap
   between brackets it lies in. The counts are a partial aggregate, so what is shuffled
   is a few gap counts and the distinct bracketed values, about 6 rows in ``ACCURACY``
   for each target. Running sums over these give every rank.

Rows are never joined on the group key by a shuffle while the brackets fit
``BROADCAST_ROWS`` groups. A target that lies outside its bracket (a sketch beyond its
promised error) is found by its gap, which becomes a bracket of one more pass."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourcast.operators.joins import join_small

ACCURACY = 10_000
MAX_PASSES = 3


def _brackets(df: DataFrame, columns, qs, keys) -> DataFrame:
    """keys, and for each column a struct (n, lo, hi): lo[t] <= target t <= hi[t]."""
    margin = 3.0 / ACCURACY
    probs = sorted({min(max(q + d, 0.0), 1.0) for q in qs for d in (-margin, margin)})

    def at(s: Column, q: float, d: float, end: Column) -> Column:
        p = q + d
        return end if not 0.0 < p < 1.0 else s[probs.index(p)]

    sketch = df.groupBy(*keys).agg(*[F.struct(
        F.count(c).alias("n"), F.min(c).alias("lo"), F.max(c).alias("hi"), F.percentile_approx(c, probs, ACCURACY).alias("s")).alias(c)
        for c in columns])
    out = []
    for c in columns:
        n, lo, hi, s = (F.col(c)[f] for f in ("n", "lo", "hi", "s"))
        few = n <= ACCURACY  # all values are kept: the sketch needn't be good
        out.append(F.struct(
            n.alias("n"), F.when(few, F.array(*[lo for _ in qs])).otherwise(F.array(*[at(s, q, -margin, lo) for q in qs])).alias("lo"),
            F.when(few, F.array(*[hi for _ in qs])).otherwise(F.array(*[at(s, q, margin, hi) for q in qs])).alias("hi")).alias(f"_b_{c}"))
    return sketch.select(*keys, *out)


def _counts(df: DataFrame, brackets: DataFrame, columns, keys, width: int | None = None) -> DataFrame:
    """keys, column, inside, _c, _lo, _hi: counts of bracketed values and of the gaps
    (inside is null) between brackets, with their least and largest value. ``width`` is the
    number of brackets where all groups have as many."""
    rows = join_small(df, brackets, keys)

    def entry(c: str) -> Column:
        v, b = F.col(c), F.col(f"_b_{c}")
        if width:
            inside = reduce(Column.__or__, [(b["lo"][i] <= v) & (v <= b["hi"][i]) for i in range(width)])
            below = reduce(Column.__add__, [(b["hi"][i] < v).cast("int") for i in range(width)])
        else:
            inside = F.exists(F.arrays_zip(b["lo"].alias("lo"), b["hi"].alias("hi")), lambda z: (z["lo"] <= v) & (v <= z["hi"]))
            below = F.size(F.filter(b["hi"], lambda u: u < v))
        gap = F.when(~inside, below)
        return F.struct(F.lit(c).alias("column"), v.alias("v"), gap.alias("gap"), F.when(inside, v).alias("inside"))

    e = rows.select(*keys, F.explode(F.array(*[entry(c) for c in columns])).alias("_e")).select(*keys, "_e.*").filter(F.col("v").isNotNull())
    return e.groupBy(*keys, "column", "gap", "inside").agg(F.count(F.lit(1)).alias("_c"), F.min("v").alias("_lo"), F.max("v").alias("_hi"))


def exact_quantiles(df: DataFrame, columns, qs, keys=()) -> DataFrame:
    """keys, column, qi, value: quantile ``qs[qi]`` of each column in each group that
    has a value of it."""
    from hourcast.session import reliable_checkpoint
    keys, columns, qs = list(keys), list(columns), [float(q) for q in qs]
    vals = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in columns])
    # a row per group, read by the second pass
    brackets = reliable_checkpoint(_brackets(vals, columns, qs, keys))
    for left in range(MAX_PASSES - 1, -1, -1):
        counts = _counts(vals, brackets, columns, keys, len(qs) if left == MAX_PASSES - 1 else None)
        w = Window.partitionBy(*keys, "column").orderBy("_lo")
        counts = counts.withColumns({"_end": F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, 0)),
                                     "_n": F.sum("_c").over(Window.partitionBy(*keys, "column"))})
        # which target ranks k0 and k0 + 1 of 0-based order lie in the entry
        start = F.col("_end") - F.col("_c")
        want = F.array(*[F.struct(F.lit(i).alias("qi"), (F.lit(q) * (F.col("_n") - 1)).alias("at")) for i, q in enumerate(qs)])
        k0 = F.floor(F.col("t.at")).cast("long")
        hit = counts.withColumn("_start", start).withColumn("t", F.explode(want))
        hit = hit.select(*keys, "column", "inside", "_lo", "_hi", "_start", "_end", F.col("t.qi").alias("qi"), (F.col("t.at") - k0).alias("_frac"),
                         F.explode(F.array(F.struct(F.lit(0).alias("j"), k0.alias("k")),
                                           F.struct(F.lit(1).alias("j"), F.least(k0 + 1, F.col("_n") - 1).alias("k")))).alias("r"))
        hit = hit.filter((F.col("r.k") >= F.col("_start")) & (F.col("r.k") < F.col("_end")))
        hit = reliable_checkpoint(hit.select(*keys, "column", "qi", "_frac", F.col("r.j").alias("j"), "inside", "_lo", "_hi"))
        missed = hit.filter(F.col("inside").isNull() & (F.col("_lo") < F.col("_hi")))
        if not left or missed.isEmpty():
            break
        more = missed.groupBy(*keys).pivot("column", columns).agg(
            F.struct(F.collect_set("_lo").alias("lo"), F.collect_set("_hi").alias("hi")))
        more = more.select(*keys, *[F.col(c).alias(f"_m_{c}") for c in columns])
        add = join_small(brackets, more, keys, "left")

        def both(c: str, side: str) -> Column:
            old = F.col(f"_b_{c}")[side]
            # the pairs of a gap are sorted alike on both sides: gaps don't overlap
            return F.concat(old, F.coalesce(F.array_sort(F.col(f"_m_{c}")[side]), F.array().cast("array<double>"))).alias(side)

        brackets = reliable_checkpoint(add.select(*keys, *[
            F.struct(F.col(f"_b_{c}")["n"].alias("n"), both(c, "lo"), both(c, "hi")).alias(f"_b_{c}") for c in columns]))
    value = {j: F.max(F.when(F.col("j") == j, F.col("_lo"))) for j in (0, 1)}
    return hit.groupBy(*keys, "column", "qi").agg((value[0] + F.first("_frac") * (value[1] - value[0])).alias("value"))


def quantiles_wide(df: DataFrame, keys, value: str, qs, names) -> DataFrame:
    """keys and a column for each quantile of ``value``."""
    keys = list(keys)
    long = exact_quantiles(df, [value], qs, keys)
    return long.groupBy(*keys).agg(*[F.max(F.when(F.col("qi") == i, F.col("value"))).alias(n)
                                     for i, n in enumerate(names)])
