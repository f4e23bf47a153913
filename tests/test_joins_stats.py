import numpy as np
import pytest
from pyspark.sql import functions as F

from hourcast.operators import joins as J
from hourcast.operators import stats as ST
from hourcast.operators.quantiles import quantiles_wide
from tests.helpers import hours


def test_forecast_window_fixture(spark):
    base = spark.createDataFrame([("s", hours(0))], "series string, timestamp timestamp_ntz")
    fc = spark.createDataFrame([("s", hours(h), v) for h, v in [(0, 1.0), (23, 3.0), (24, 5.0), (71, 7.0), (72, 9.0)]],
                               "series string, timestamp timestamp_ntz, fc_pm25 double")
    r = J.forecast_windows(base, fc, bucket_seconds=86400).first()
    assert (r.fc_pm25_24h, r.fc_pm25_48h, r.fc_pm25_72h) == (2.0, 5.0, 7.0)
    assert r.fc_dust_24h is None


def test_forecast_empty_window(spark):
    base = spark.createDataFrame([("s", hours(100))], "series string, timestamp timestamp_ntz")
    fc = spark.createDataFrame([("s", hours(0), 1.0)], "series string, timestamp timestamp_ntz, fc_pm25 double")
    r = J.forecast_windows(base, fc).first()
    assert r.fc_pm25_24h is None and r.fc_pm25_72h is None


@pytest.mark.parametrize("bucket", [3600, 86400, 7 * 86400])
def test_forecast_windows_bucket_invariant(spark, bucket):
    rng = np.random.default_rng(3)
    base = spark.createDataFrame([("s", hours(int(h))) for h in range(0, 300, 5)], "series string, timestamp timestamp_ntz")
    fc = spark.createDataFrame([("s", hours(int(h)), float(rng.uniform(0, 100))) for h in range(0, 400)],
                               "series string, timestamp timestamp_ntz, fc_pm25 double")
    ref = {r.timestamp: (r.fc_pm25_24h, r.fc_pm25_72h) for r in J.forecast_windows(base, fc, bucket_seconds=10**9).collect()}
    got = {r.timestamp: (r.fc_pm25_24h, r.fc_pm25_72h) for r in J.forecast_windows(base, fc, bucket_seconds=bucket).collect()}
    assert ref == got


def test_anti_join_idempotent(spark):
    new = spark.createDataFrame([("s", hours(0)), ("s", hours(1))], "series string, timestamp timestamp_ntz")
    old = spark.createDataFrame([("s", hours(0))], "series string, timestamp timestamp_ntz")
    assert [r.timestamp for r in J.anti_join_new(new, old).collect()] == [hours(1)]


@pytest.mark.parametrize("n", [1, 2, 7, 1000, 9000])
def test_exact_quantiles_match_numpy(spark, n):
    rng = np.random.default_rng(n)
    xs = np.round(rng.gamma(2.0, 30.0, size=n), 2)
    xs[: n // 3] = xs[0]  # a heavy duplicate value
    df = spark.createDataFrame([("g", float(x)) for x in xs], "g string, v double")
    r = quantiles_wide(df, ["g"], "v", [0.25, 0.5, 0.75], ["a", "b", "c"]).first()
    exp = np.quantile(xs, [0.25, 0.5, 0.75])
    assert [r.a, r.b, r.c] == pytest.approx(list(exp), rel=1e-12)


def test_exact_quantiles_large_groups(spark, monkeypatch):
    """Groups above the sketch's exact size: only bracketed values keep their own count."""
    import hourcast.operators.quantiles as Q
    monkeypatch.setattr(Q, "ACCURACY", 200)
    rng = np.random.default_rng(5)
    xs = np.round(rng.lognormal(3, 1, size=5000), 3)
    xs[:2000] = 17.0
    rows = [("g", float(x), float(-x)) for x in xs] + [("h", float(x), None) for x in xs[:7]] + [(None, 1.0, 2.0)] * 3
    df = spark.createDataFrame(rows, "g string, v double, w double")
    got = {(r.g, r.column, r.qi): r.value for r in Q.exact_quantiles(df, ["v", "w"], [0.1, 0.5, 0.9], ["g"]).collect()}
    assert len(got) == 12 + 3
    for i, q in enumerate([0.1, 0.5, 0.9]):
        assert got["g", "v", i] == pytest.approx(np.quantile(xs, q), rel=1e-12)
        assert got["g", "w", i] == pytest.approx(np.quantile(-xs, q), rel=1e-12)
        assert got["h", "v", i] == pytest.approx(np.quantile(xs[:7], q), rel=1e-12)
        assert (got[None, "v", i], got[None, "w", i]) == (1.0, 2.0)
    brackets = Q._brackets(df, ["v"], [0.1, 0.5, 0.9], ["g"])
    kept = Q._counts(df, brackets, ["v"], ["g"]).filter("g = 'g'").collect()
    assert sum(r._c for r in kept) == 5000 and len(kept) < 1000


def test_quantile_rows_are_not_shuffled_by_group(spark):
    """Rows meet the brackets by a broadcast; what is exchanged are counts."""
    import hourcast.operators.quantiles as Q
    df = spark.range(50_000).select((F.col("id") % 3).alias("g"), F.col("id").cast("double").alias("v"))
    plan = Q._counts(df, Q._brackets(df, ["v"], [0.5], ["g"]), ["v"], ["g"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert plan.count("Exchange hashpartitioning(g") == 2  # partial counts, and the sketch's partial state
    assert plan.index("HashAggregate(keys=[g") < plan.index("Exchange hashpartitioning(g")


def test_quantiles_outside_their_brackets(spark, monkeypatch):
    """A sketch that breaks its promise costs a pass, not exactness."""
    import hourcast.operators.quantiles as Q
    wrong = Q._brackets

    def brackets(df, columns, qs, keys):
        return wrong(df, columns, [0.9 for _ in qs], keys)

    monkeypatch.setattr(Q, "ACCURACY", 100)
    monkeypatch.setattr(Q, "_brackets", brackets)
    xs = np.concatenate([np.linspace(0, 1e-6, 3000), [1e6], np.arange(500.0)])
    df = spark.createDataFrame([("g", float(x)) for x in xs], "g string, v double")
    r = Q.quantiles_wide(df, ["g"], "v", [0.05, 0.3, 0.99], ["a", "b", "c"]).first()
    assert [r.a, r.b, r.c] == pytest.approx(list(np.quantile(xs, [0.05, 0.3, 0.99])), rel=1e-12)


def test_kde_equals_direct_sum(spark):
    """Two series, one with an outlier and repeats; and one without spread."""
    rng = np.random.default_rng(2)
    data = {"a": np.concatenate([rng.normal(50, 10, 800), [900.0], [55.5] * 300]), "b": rng.gamma(2, 5, 60)}
    rows = [(s, float(x)) for s, xs in data.items() for x in xs] + [("c", 1.0)] * 3
    got = ST.kde(spark.createDataFrame(rows, "series string, v double"), "v", grid=50).collect()
    for s, xs in data.items():
        h = xs.std(ddof=1) * len(xs) ** -0.2
        for r in (r for r in got if r.series == s):
            want = np.exp(-0.5 * ((r.x - xs) / h) ** 2).sum() / (len(xs) * h * np.sqrt(2 * np.pi))
            assert r.density == pytest.approx(want, rel=1e-9, abs=1e-14)
    assert all(r.density is None for r in got if r.series == "c")


def test_histogram_exchanges_bins_only(spark):
    df = spark.range(20_000).select(F.lit("s").alias("series"), F.col("id").cast("double").alias("v"))
    h = ST.histogram(df, "v", 10)
    assert [r["count"] for r in h.orderBy("bin").collect()] == [2000] * 10
    plan = h._jdf.queryExecution().executedPlan().toString()
    assert "_x" not in " ".join(x for x in plan.splitlines() if "Exchange hashpartitioning" in x)


def test_metrics_fixture(spark):
    from hourcast.operators.ml import regression_metrics
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0), (3.0, 3.0), (4.0, 6.0)], "y double, p double")
    r = regression_metrics(df.withColumn("model", F.lit("m")), ["model"], "y", "p").first()
    assert (r.rmse, r.mae, r.r2) == (1.0, 0.5, 0.2)


def test_qq_fit_with_heavy_duplicate(spark, monkeypatch):
    """A value held by a third of the rows: ranks split into many pieces, fit
    equal to a direct computation with the exact inverse normal."""
    from statistics import NormalDist

    import hourcast.operators.stats as ST
    monkeypatch.setattr(ST, "RANK_SPLIT", 37)
    rng = np.random.default_rng(9)
    xs = np.round(rng.normal(100, 15, 900), 1)
    xs[:300] = 88.8
    df = spark.createDataFrame([("s", float(x)) for x in xs], "series string, v double")
    r = ST.qq_fit(df, "v").first()
    n = len(xs)
    srt = np.sort(xs)
    i = np.arange(1, n + 1)
    m = (i - 0.3175) / (n + 0.365)
    m[0], m[-1] = 1 - 0.5 ** (1 / n), 0.5 ** (1 / n)
    osm = np.array([NormalDist().inv_cdf(p) for p in m])
    slope, intercept = np.polyfit(osm, srt, 1)
    assert r.n == n
    assert r.slope == pytest.approx(slope, rel=1e-7) and r.intercept == pytest.approx(intercept, rel=1e-7)
    assert r.r == pytest.approx(np.corrcoef(osm, srt)[0, 1], rel=1e-7)


def test_arg_extremes_of_string_keys_take_the_lowest_on_a_tie(spark):
    from hourcast.operators.aggregates import arg_extremes
    prof = spark.createDataFrame([("s", "2024-02", 5.0), ("s", "2024-01", 5.0), ("s", "2024-03", 5.0)], "series string, k string, mean double")
    assert tuple(arg_extremes(prof, "k").first()) == ("s", "2024-01", "2024-01")


def test_value_buckets_resist_an_outlier(spark):
    """One huge outlier leaves the buckets of distinct values even."""
    df = spark.range(20000).select(F.lit("s").alias("series"), (F.col("id") * 0.5).alias("v"))
    df = df.union(spark.createDataFrame([("s", 1e12)], "series string, v double"))
    counts = ST.value_counts(df, "v")
    sizes = [r["count"] for r in ST.value_buckets(counts, bucket_count=64).groupBy("_bk").count().collect()]
    assert sum(sizes) == 20001 and max(sizes) <= 2 * sum(sizes) / len(sizes)
