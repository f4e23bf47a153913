import pytest
from pyspark.sql import functions as F

from hourcast.operators import windows as WN
from hourcast.operators.halo import Halo, PositionalPlan
from tests.helpers import col, hours, series_frame


def test_rolling_small_with_null(spark):
    df = series_frame(spark, [("s", hours(i), v) for i, v in enumerate([1.0, None, 3.0, 5.0])])
    out = WN.add_rolling(df, windows=[2])
    assert col(out, "rolling_mean_2h") == [1.0, 1.0, 3.0, 4.0]
    std = col(out, "rolling_std_2h")
    assert std[:3] == [None, None, None] and std[3] == pytest.approx(1.41421356, abs=1e-8)


def test_one_row(spark):
    df = series_frame(spark, [("s", hours(0), 42.0)])
    r = WN.add_engineered_features(df).first()
    assert r.aqi_lag_1h is None and r.rolling_mean_6h == 42.0 and r.rolling_std_6h is None
    assert r.hours_since_prev == 0.0 and r.is_gap == 0


def test_gap_series_and_exact_horizon(spark):
    hrs = [h for h in range(30) if h not in (10, 11, 12)]
    df = WN.add_engineered_features(series_frame(spark, [("s", hours(h), float(h)) for h in hrs]))
    gaps = {r.timestamp.hour: (r.is_gap, r.hours_since_prev) for r in df.collect()}
    assert [h for h, (g, _) in gaps.items() if g == 1] == [13] and gaps[13][1] == 4.0
    assert WN.build_training_frame(df, 24).count() == 0


@pytest.mark.parametrize("h,kept", [(24, 76), (48, 52), (72, 28)])
def test_no_gap_horizons(spark, h, kept):
    df = series_frame(spark, [("s", hours(i), float(i)) for i in range(100)])
    tf = WN.build_training_frame(df, h)
    assert tf.count() == kept
    r = tf.orderBy("timestamp").first()
    assert r[f"aqi_next_{h}h"] == float(h)


@pytest.mark.parametrize("strategy", ["plain", "halo"])
def test_split_counts(spark, strategy):
    rows = [(s, hours(i), 1.0) for s, n in (("a", 10), ("b", 11), ("c", 4)) for i in range(n)]
    sp = WN.chronological_split(series_frame(spark, rows), strategy=strategy)
    got = {r.series: r["count"] for r in sp.filter("split = 'train'").groupBy("series").count().collect()}
    assert got == {"a": 8, "b": 8, "c": 3}


def test_ffill_does_not_cross_split(spark):
    df = spark.createDataFrame([("s", hours(0), None, "train"), ("s", hours(1), 2.0, "train"),
                                ("s", hours(2), None, "train"), ("s", hours(3), None, "test"),
                                ("s", hours(4), 5.0, "test")],
                               "series string, timestamp timestamp_ntz, x double, split string")
    out = WN.forward_fill(df, ["x"], partition=("series", "split"))
    assert col(out, "x") == [0.0, 2.0, 2.0, 0.0, 5.0]


def test_halo_equals_plain_with_small_chunks(spark):
    """Chunk-with-halo with tiny chunks must equal the single-partition window."""
    import random
    rnd = random.Random(7)
    rows = []
    for s in ("a", "b"):
        t = 0
        for _ in range(400):
            t += rnd.choice([1, 1, 1, 2, 3])
            rows.append((s, hours(t), rnd.choice([None, rnd.uniform(0, 300)])))
    df = series_frame(spark, rows)
    plain = WN.add_engineered_features(df)
    cols = ["series", "timestamp", "aqi_lag_24h", "rolling_mean_24h", "rolling_std_6h", "hours_since_prev"]
    plan = PositionalPlan(df, lookback=24, lookahead=72, strategy=Halo(80, 86400))
    w = plan.window
    staged = plan.df.withColumns({**WN.gap_columns(w), **WN.lag_columns(w), **WN.rolling_columns(w),
                                  "lead72": F.lead("aqi", 72).over(w)})
    halo = plan.finish(staged)
    a = sorted(tuple(r) for r in plain.select(*cols).collect())
    b = sorted(tuple(r) for r in halo.select(*cols).collect())
    assert len(a) == len(b) == 800
    for x, y in zip(a, b):
        assert x[:2] == y[:2]
        for u, v in zip(x[2:], y[2:]):
            assert (u is None and v is None) or u == pytest.approx(v, rel=1e-12, abs=1e-12)
    plain_lead = df.withColumn("lead72", F.lead("aqi", 72).over(WN.series_window()))
    assert sorted((r.series, r.timestamp, r.lead72) for r in plain_lead.collect()) == \
        sorted((r.series, r.timestamp, r.lead72) for r in halo.select("series", "timestamp", "lead72").collect())


def test_shifted_backfill(spark):
    from hourcast.schema import FORECAST_WINDOW_COLUMNS
    rows = [("s", hours(i), float(i), float(i), float(i), float(i), float(i)) for i in range(30)]
    df = spark.createDataFrame(rows, "series string, timestamp timestamp_ntz, pm25 double, co double, no2 double, so2 double, o3 double")
    df = df.withColumns({c: F.lit(None).cast("double") for c in FORECAST_WINDOW_COLUMNS})
    out = WN.shifted_backfill(df).orderBy("timestamp").collect()
    assert out[0].fc_pm25_24h == 24.0 and out[5].fc_pm25_24h == 29.0 and out[6].fc_pm25_24h is None
    assert out[0].fc_dust_72h == 0.0 and out[0].fc_co_48h is None


def test_sequences_skip_nulls(spark):
    rows = [("s", hours(i), float(i), None if i == 30 else float(i)) for i in range(60)]
    df = spark.createDataFrame(rows, "series string, timestamp timestamp_ntz, a double, y double")
    seq = WN.sequences(df, ["a"], "y", lookback=24)
    ends = sorted(r.timestamp for r in seq.collect())
    # windows end at rows 23..59; the row with NULL target (30) is skipped
    assert len(ends) == 36 and hours(30) not in ends
    assert len(seq.first().x) == 24


def test_whole_pipeline_halo_equals_plain_with_tiny_chunks(spark, monkeypatch):
    """Every default (halo) positional operator, forced into many small chunks
    and buckets, equals the one-task-per-series plan."""
    import random

    import hourcast.operators.halo as H
    monkeypatch.setattr(H, "DEFAULT_CHUNK_ROWS", 75)
    monkeypatch.setattr(H, "DEFAULT_BUCKET_SECONDS", 86400)
    monkeypatch.setattr(H, "SUPER_CHUNKS", 2)
    rnd = random.Random(11)
    rows = []
    for s in ("a", "b", "c"):
        t = 0
        for _ in range(300 if s != "c" else 5):
            t += rnd.choice([1, 1, 1, 1, 2, 3])
            rows.append((s, hours(t), rnd.choice([None, None, rnd.uniform(0, 300)])))
    df = series_frame(spark, rows)

    def norm(d, cols):
        out = []
        for r in d.select(*cols).collect():
            out.append(tuple(round(v, 9) if isinstance(v, float) else v for v in r))
        return sorted(out, key=lambda r: tuple((x is None, x) for x in r))

    feats_p = WN.add_engineered_features(df, strategy="plain")
    feats_h = WN.add_engineered_features(df, strategy="halo")
    cols = feats_p.columns
    assert norm(feats_p, cols) == norm(feats_h, cols)
    sp_p = WN.chronological_split(feats_p, strategy="plain")
    sp_h = WN.chronological_split(feats_p, strategy="halo")
    assert norm(sp_p, ["series", "timestamp", "split"]) == norm(sp_h, ["series", "timestamp", "split"])
    ff_cols = ["series", "timestamp", "split", "aqi", "aqi_lag_3h"]
    ff_p = WN.forward_fill(sp_p, ["aqi", "aqi_lag_3h"], partition=("series", "split"), strategy="plain")
    ff_h = WN.forward_fill(sp_p, ["aqi", "aqi_lag_3h"], partition=("series", "split"), strategy="halo")
    assert norm(ff_p, ff_cols) == norm(ff_h, ff_cols)
    cg_cols = ["series", "timestamp", "gap_hours", "step", "cum_one_hour_pct"]
    assert norm(WN.cumulative_gap_share(df, strategy="plain"), cg_cols) == \
        norm(WN.cumulative_gap_share(df, strategy="halo"), cg_cols)
    filled = WN.forward_fill(feats_p, ["aqi"], strategy="plain")
    tf_p = WN.build_training_frame(filled, 24, strategy="plain")
    tf_h = WN.build_training_frame(filled, 24, strategy="halo")
    assert norm(tf_p, tf_p.columns) == norm(tf_h, tf_p.columns)
    sq_p = WN.sequences(filled, ["aqi", "rolling_mean_6h"], "aqi_lag_1h", 24, strategy="plain")
    sq_h = WN.sequences(filled, ["aqi", "rolling_mean_6h"], "aqi_lag_1h", 24, strategy="halo")
    assert sq_p.count() > 0
    assert sorted(map(str, sq_p.collect())) == sorted(map(str, sq_h.collect()))


def _air_and_weather(df):
    air = df.select("series", "timestamp", *[F.col("aqi").alias(c) for c in ("pm25", "pm10", "o3", "no2", "so2", "co")])
    return air, df.select("series", "timestamp", *[F.col("aqi").alias(c) for c in ("temperature", "humidity", "wind_speed")])


def test_building_positional_plans_starts_no_job(spark):
    """Nothing is measured or written while a plan is built, whatever the strategy."""
    from hourcast.plans.backfill import build_backfill_dataset
    df = series_frame(spark, [("s", hours(i), float(i)) for i in range(200)])
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("build-only", "")
    for strategy in (None, "plain", "halo", Halo(80, 86400)):
        feats = WN.add_engineered_features(df, strategy=strategy)
        WN.sequences(WN.build_training_frame(feats, 24, strategy=strategy), ["aqi"], "aqi_next_24h", strategy=strategy)
        WN.prediction_frame(df, strategy=strategy)
        WN.cumulative_gap_share(df, strategy=strategy)
        build_backfill_dataset(*_air_and_weather(df), strategy=strategy)
    assert list(tracker.getJobIdsForGroup("build-only")) == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    with pytest.raises(ValueError):
        WN.add_lags(df, strategy="auto")


def test_positions_shared_by_a_pipeline(spark):
    """Back-fill under shared positions equals the plain plan, and no helper column stays."""
    from hourcast.plans.backfill import build_backfill_dataset
    air, weather = _air_and_weather(series_frame(spark, [("s", hours(i + i // 40), float(i % 90)) for i in range(300)]))
    plain = build_backfill_dataset(air, weather, strategy="plain")
    halo = build_backfill_dataset(air, weather, strategy=Halo(96, 86400))
    assert plain.columns == halo.columns
    assert sorted(map(str, plain.collect())) == sorted(map(str, halo.collect()))


def test_gap_free_series_horizon_counts(spark):
    """All events as one hourly series: 720 hours, no gaps; exact-horizon survivors 696/672/648."""
    import os
    from hourcast.sources import testbind as TB
    sf = "/root/testdata/sf0.01"
    if not os.path.isdir(sf):
        return
    feats = WN.add_engineered_features(TB.all_hourly(spark, sf))
    assert feats.count() == 720 and feats.filter("is_gap = 1").count() == 0
    assert [WN.build_training_frame(feats, h).count() for h in (24, 48, 72)] == [696, 672, 648]


def _gappy(spark, seed, n=200):
    import random
    rnd = random.Random(seed)
    t, rows = 0, []
    for _ in range(n):
        t += rnd.choice([1] * 40 + [2, 5])
        rows.append(("s", hours(t), rnd.uniform(0, 300)))
    return series_frame(spark, rows), rows


@pytest.mark.parametrize("seed", [1, 2])
def test_exact_horizon_subset_of_time_equijoin(spark, seed):
    """Every kept target row has a row exactly h hours later whose aqi is the target."""
    df, rows = _gappy(spark, seed)
    by_time = {ts: v for _, ts, v in rows}
    from datetime import timedelta
    for h in (24, 48):
        tf = WN.build_training_frame(df, h).collect()
        assert len(tf) > 0
        for r in tf:
            assert by_time[r.timestamp + timedelta(hours=h)] == r[f"aqi_next_{h}h"]


def test_future_change_does_not_touch_past_features(spark):
    df, rows = _gappy(spark, 3)
    cut = rows[120][1]
    changed = series_frame(spark, [(s, t, v + 1000.0 if t > cut else v) for s, t, v in rows])
    cols = ["timestamp", "aqi_lag_1h", "aqi_lag_24h", "rolling_mean_24h", "rolling_std_6h", "hours_since_prev"]
    a = WN.add_engineered_features(df).filter(F.col("timestamp") <= F.lit(cut)).select(*cols)
    b = WN.add_engineered_features(changed).filter(F.col("timestamp") <= F.lit(cut)).select(*cols)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
