"""Grouped profiles of an hourly series table (seasonal means, shares, bands,
descriptive tables, null/schema/coverage profiles, gap counts). All are
single aggregate passes with map-side partial aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window  # noqa: F401
from pyspark.sql import functions as F

from hourcast.functions.calendar import hours_between, local_time
from hourcast.functions.numeric import round_stable
from hourcast.operators.quantiles import exact_quantiles, quantiles_wide
from hourcast.schema import LOCAL_TZ, SERIES, TS

# ---- fixed values: AQI share and band thresholds ------------------------------------------
SHARE_GOOD_MAX = 50
SHARE_MODERATE_MAX = 100
BANDS = [("Good (<=50)", None, 50), ("Moderate (51-100)", 50, 100), ("Unhealthy SG (101-150)", 100, 150),
         ("Unhealthy (151-200)", 150, 200), ("Very Unhealthy (>200)", 200, None)]
# -----------------------------------------------------------------------------------------------


def with_local_parts(df: DataFrame, ts=TS, tz: str = LOCAL_TZ) -> DataFrame:
    lt = local_time(ts, tz)
    return df.withColumns({
        "local_ts": lt,
        "local_hour": F.hour(lt).cast("long"),
        "local_dow": F.weekday(lt).cast("long"),
        "local_month": F.month(lt).cast("long"),
        "local_date": F.to_date(lt),
        "local_period": F.date_format(lt, "yyyy-MM"),
    })


def profile(df: DataFrame, by: str, value="aqi", series=SERIES, std: bool = False, tz: str = LOCAL_TZ) -> DataFrame:
    """Mean (and sample std) of ``value`` per series and local calendar part."""
    data = with_local_parts(df, tz=tz)
    aggs = [F.avg(value).alias("mean")]
    if std:
        aggs.append(F.stddev_samp(value).alias("std"))
    return data.groupBy(series, F.col(by)).agg(*aggs)


def daily_resample(df: DataFrame, value="aqi", series=SERIES, tz: str = LOCAL_TZ) -> DataFrame:
    """Calendar-day means with empty (all-NULL) days removed."""
    return profile(df, "local_date", value, series, tz=tz).filter(F.col("mean").isNotNull())


def arg_extremes(prof: DataFrame, key: str, series=SERIES) -> DataFrame:
    """Per series: key of the highest and lowest mean; lowest key wins ties."""
    if prof.schema[key].dataType.typeName() == "string":
        return arg_extremes_str(prof, key, series)
    return prof.groupBy(series).agg(
        F.max_by(key, F.struct(F.col("mean"), -F.col(key))).alias("peak"),
        F.min_by(key, F.struct(F.col("mean"), F.col(key))).alias("clean"),
    )


def arg_extremes_str(prof: DataFrame, key: str, series=SERIES) -> DataFrame:
    """String keys: first (lowest) key wins ties for both extremes."""
    top = F.max(F.col("mean")).over(Window.partitionBy(series))
    bot = F.min(F.col("mean")).over(Window.partitionBy(series))
    t = prof.withColumns({"_top": top, "_bot": bot})
    return t.groupBy(series).agg(F.min(F.when(F.col("mean") == F.col("_top"), F.col(key))).alias("peak"),
                                 F.min(F.when(F.col("mean") == F.col("_bot"), F.col(key))).alias("clean"))


def global_stats(df: DataFrame, value="aqi", series=SERIES, ts=TS) -> DataFrame:
    base = df.groupBy(series).agg(
        F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"), F.max(value).alias("max"),
        F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"))
    med = quantiles_wide(df, [series], value, [0.5], ["median"])
    return base.join(med, series, "left")


def shares(df: DataFrame, value="aqi", series=SERIES) -> DataFrame:
    """Percent of all rows (NULL counts in the denominator) per AQI share band."""
    v = F.col(value)

    def pct(cond: Column) -> Column:
        return F.avg(F.coalesce(cond.cast("double"), F.lit(0.0))) * 100.0

    return df.groupBy(series).agg(
        pct(v <= SHARE_GOOD_MAX).alias("good_pct"),
        pct((v > SHARE_GOOD_MAX) & (v <= SHARE_MODERATE_MAX)).alias("moderate_pct"),
        pct(v > SHARE_MODERATE_MAX).alias("unhealthy_pct"),
    )


def band_counts(df: DataFrame, value="aqi", series=SERIES) -> DataFrame:
    """Five-band counts and % of all rows, long form."""
    v = F.col(value)
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, (_, lo, hi) in enumerate(BANDS):
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (v > lo)
        if hi is not None:
            cond = cond & (v <= hi)
        aggs.append(F.count_if(cond).alias(f"_b{i}"))
    wide = df.groupBy(series).agg(*aggs)
    stack = ", ".join(f"'{name}', _b{i}" for i, (name, _, _) in enumerate(BANDS))
    long = wide.selectExpr(series, "_n", f"stack({len(BANDS)}, {stack}) AS (band, count)")
    return long.select(series, "band", "count", (F.col("count") * 100.0 / F.col("_n")).alias("pct"))


def unpivot_values(df: DataFrame, columns, keep=()) -> DataFrame:
    return df.select(*keep, *[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        list(keep), list(columns), "column", "value")


def describe(df: DataFrame, columns) -> DataFrame:
    """count, mean, std, min, 25/50/75 %, max, cv% per column (rounded as shown)."""
    stats = {"count": lambda c: F.count(c).cast("double"), "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    num = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    wide = num.agg(*[F.struct(*[f(c).alias(n) for n, f in stats.items()]).alias(c) for c in columns])
    stack = ", ".join(f"'{c}', `{c}`" for c in columns)
    base = wide.selectExpr(f"stack({len(columns)}, {stack}) AS (column, s)").select("column", "s.*")
    q = exact_quantiles(df, columns, [0.25, 0.5, 0.75]).groupBy("column").agg(*[
        F.max(F.when(F.col("qi") == i, F.col("value"))).alias(n) for i, n in enumerate(["p25", "p50", "p75"])])
    out = base.join(q, "column", "left")
    r3 = {c: round_stable(c, 3) for c in ["mean", "std", "min", "p25", "p50", "p75", "max"]}
    return out.withColumns({"cv_pct": round_stable(round_stable(F.col("std") / F.col("mean") * 100.0, 1), 3), **r3})


def null_profile(df: DataFrame, columns=None) -> DataFrame:
    """Columns with NULLs: count and % (rounded 2), descending."""
    cols = columns or df.columns
    agg = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    stack = ", ".join(f"'{c}', `{c}`" for c in cols)
    long = agg.selectExpr("_n", f"stack({len(cols)}, {stack}) AS (column, missing_count)")
    return (long.filter("missing_count > 0")
            .select("column", "missing_count",
                    round_stable(F.col("missing_count") * 100.0 / F.col("_n"), 2).alias("missing_pct")))


def schema_profile(df: DataFrame) -> DataFrame:
    """column, Spark type, non-null count (one pass)."""
    cols = df.columns
    agg = df.agg(*[F.count(F.col(c)).alias(c) for c in cols])
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    stack = ", ".join(f"'{c}', '{types[c]}', `{c}`" for c in cols)
    return agg.selectExpr(f"stack({len(cols)}, {stack}) AS (column, dtype, non_null)")


def gap_steps(df: DataFrame, series=SERIES, ts=TS, strategy: str | None = None) -> DataFrame:
    """series, gap_hours for every step between consecutive rows of a series."""
    from hourcast.operators.halo import PositionalPlan
    plan = PositionalPlan(df.select(series, ts), series, ts, lookback=1, strategy=strategy)
    g = plan.finish(plan.df.withColumn("gap_hours", hours_between(F.col(ts), F.lag(ts, 1).over(plan.window))))
    return g.select(series, "gap_hours").filter(F.col("gap_hours").isNotNull())


def gap_counts(df: DataFrame, series=SERIES, ts=TS, strategy: str | None = None) -> DataFrame:
    """Hours between consecutive rows of each series -> count per gap size."""
    return gap_steps(df, series, ts, strategy).groupBy("gap_hours").agg(F.count(F.lit(1)).alias("count"))
