"""Micro-batches of any shape give what the batch job gives."""

from datetime import timedelta

from pyspark.sql import functions as F

from hourcast.functions.aqi import pm25_to_aqi, pm25_to_aqi_rounded
from hourcast.operators.sinks import append_new, read_table, stored_between, stored_rows
from hourcast.operators.windows import add_engineered_features
from hourcast.streaming import jobs

from helpers import hours, series_frame

EVENTS = "event_id long, ts timestamp_ntz, event_type string, user_id long, value double, props string"


def events(spark, n=400):
    rows = [(i, hours(0) + timedelta(minutes=(i * 37) % 3000), "ab"[i % 2], i % 7, None if i % 11 == 0 else float(i % 53), f'{{"k": {i % 5}}}')
            for i in range(n)]
    return spark.createDataFrame(rows, EVENTS)


def rounded(df):
    cols = [F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    return sorted(map(str, df.select(*cols).collect()))


def stream(spark, ev, files, scratch, descending=False):
    landing = f"{scratch}/in{files}{descending}"
    order = F.col("ts").desc() if descending else F.col("ts")
    ev.repartitionByRange(files, order).write.parquet(landing)
    out = f"{landing}-out"
    jobs.hourly_aggregate_stream(spark, landing, ev.schema, out, f"{landing}-ckpt", max_files=1).awaitTermination()
    return rounded(jobs.read_hourly_aggregate(spark, out))


def test_one_file_many_files_reversed_files(spark, scratch):
    ev = events(spark)
    want = rounded(jobs.merged_hours(jobs.partial_hours(ev)))
    assert stream(spark, ev, 1, scratch) == stream(spark, ev, 5, scratch) == stream(spark, ev, 5, scratch, True) == want


def test_redelivered_events_count_once(spark, scratch):
    ev = events(spark)
    path = f"{scratch}/events"
    ev.write.parquet(path)
    got = jobs.run_hourly_aggregate_redelivered(spark, path, copies=3, files=6)
    assert rounded(got) == rounded(jobs.merged_hours(jobs.partial_hours(ev)))


def features(spark, stored, batch, table):
    """Features of the batch's new keys, after the stored hours were appended."""
    if stored:
        append_new(spark, add_engineered_features(series_frame(spark, [("s", hours(h), float(h)) for h in stored])), table)
    new = jobs.features_for_batch(spark, series_frame(spark, [("s", hours(h), float(h)) for h in batch]), table)
    append_new(spark, new, table)
    return {r.timestamp: r for r in stored_rows(spark, table).collect()}


def test_overlapping_batch(spark, scratch):
    got = features(spark, range(31), [30, 30, 31], f"{scratch}/t")
    r = got[hours(31)]
    assert (r.aqi_lag_3h, r.aqi_lag_24h) == (28.0, 7.0) and len(got) == 32


def test_late_row_has_its_own_past(spark, scratch):
    got = features(spark, [h for h in range(131) if h != 40], [40], f"{scratch}/t")
    assert got[hours(40)].aqi_lag_1h == 39.0 and got[hours(40)].aqi_lag_24h == 16.0


def test_station_silent_for_ten_weeks(spark, scratch):
    got = features(spark, range(31), [30 + 24 * 70], f"{scratch}/t")
    assert got[hours(30 + 24 * 70)].aqi_lag_1h == 30.0


def test_append_reads_the_batch_months_only(spark, scratch):
    table = f"{scratch}/t"
    rows = [("s", hours(24 * 20 * i), 1.0) for i in range(10)]
    append_new(spark, series_frame(spark, rows), table, drop=())
    plan = stored_between(read_table(spark, table), hours(0), hours(5))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ym" in plan and "2024-01" in plan


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(float("nan"),), (None,), (12.0,)], "x double")
    got = df.select(pm25_to_aqi("x").alias("a"), pm25_to_aqi_rounded("x").alias("b")).collect()
    assert [tuple(r) for r in got] == [(None, None), (None, None), (50.0, 50.0)]


def test_event_redelivered_with_another_day_is_stored_once(spark, scratch):
    landing, out = f"{scratch}/in", f"{scratch}/out"
    ev = events(spark, 3)
    later = ev.withColumn("ts", F.col("ts") + F.expr("interval 3 days"))
    for i, part in enumerate((ev, later, ev, later.filter("event_id = 1").withColumn("event_id", F.lit(None).cast("long")))):
        part.coalesce(1).write.mode("append").parquet(landing)
        jobs.distinct_event_stream(spark, landing, ev.schema, out, f"{scratch}/ckpt", max_files=1).awaitTermination()
    got = spark.read.parquet(out)
    assert sorted(r.event_id for r in got.filter("event_id is not null").collect()) == [0, 1, 2]
    assert got.filter("event_id is null").count() == 1


def test_key_index_over_many_runs(spark, scratch, monkeypatch):
    """Three levels of runs; lookups read only the buckets that may hold a key."""
    from hourcast.streaming import keyindex, runs
    monkeypatch.setattr(runs, "FANOUT", 3)
    monkeypatch.setattr(keyindex, "BUCKET_KEYS", 8)
    for name in ("live", "merges"):
        old = getattr(runs, name)
        monkeypatch.setattr(runs, name, lambda b, old=old: old(b, 3))
    assert runs.live(14) == [(2, 0), (1, 3), (0, 12), (0, 13)]
    index = keyindex.KeyIndex(spark, f"{scratch}/idx", "k", "bigint")

    def keys(xs):
        return spark.createDataFrame([(x,) for x in xs], "k long")

    batches = [range(i * 100, i * 100 + (40 if i == 3 else 5)) for i in range(10)]
    for n, b in enumerate(batches):
        assert index.seen(keys(b), n) is None or index.seen(keys(b), n).count() == 0
        index.add(keys(b), n)
        index.add(keys(b), n)  # a replay
    got = index.seen(keys([2, 102, 304, 339, 901, 50, 345, None]), 10)
    assert sorted(r.k for r in got.collect()) == [2, 102, 304, 339, 901]
    found = index.candidates(keys([304]), 10)
    where = found.select("level", "run", "folder").distinct().collect()
    assert len(where) == 1
    plan = index.held_keys(found, 10)._jdf.queryExecution().executedPlan().toString()
    assert f"run={where[0].run}/folder={where[0].folder}" in plan and plan.count("folder=") == 1
    assert index.held_keys(index.candidates(keys([10**9]), 10), 10) is None


def landed(spark, scratch, name, deliveries):
    """The stored table after the deliveries [(series, hour, aqi)], one stream run each."""
    landing, table = f"{scratch}/{name}-in", f"{scratch}/{name}"
    for rows in deliveries:
        df = series_frame(spark, [(s, hours(h), a) for s, h, a in rows])
        df.coalesce(1).write.mode("append").parquet(landing)
        jobs.feature_append_stream(spark, landing, df.schema, table, f"{scratch}/{name}-ck").awaitTermination()
    return stored_rows(spark, table)


def test_stream_equals_batch_features_over_tails(spark, scratch, monkeypatch):
    """In-order deliveries, repeats, nulls and late rows near and far, with short tails."""
    monkeypatch.setattr(jobs.tails, "TAIL_ROWS", 60)
    monkeypatch.setattr(jobs, "HISTORY_ROWS", 50)
    first = [("a", h, float(h % 17)) for h in range(0, 140) if h not in (20, 125)] + [("b", h, None if h % 9 == 0 else float(h)) for h in range(0, 30)]
    second = [("a", h, float(h % 17)) for h in range(138, 150)] + [("b", h, float(h)) for h in range(30, 40)]
    got = landed(spark, scratch, "t", [first, second, second, [("a", 125, 6.0)], [("a", 20, 3.0), ("c", 5, 1.0)]])
    at = {(r.series, r.timestamp): r for r in got.collect()}
    assert len(at) == got.count() == 150 + 40 + 1
    # A new row has the features that the whole history before it gives.
    whole = add_engineered_features(series_frame(spark, [(s, hours(h), a) for s, h, a in first + second[2:] if a is not None]))
    for r in whole.filter((F.col("timestamp") >= hours(140)) | ((F.col("series") == "b") & (F.col("timestamp") >= hours(30)))).collect():
        if r.series == "a" or r.timestamp >= hours(30):
            own = at[r.series, r.timestamp]
            assert (own.aqi_lag_24h, own.rolling_mean_24h, own.rolling_std_6h) == (r.aqi_lag_24h, r.rolling_mean_24h, r.rolling_std_6h)
    assert at["a", hours(125)].aqi_lag_1h == float(124 % 17) and at["a", hours(20)].aqi_lag_1h == float(19 % 17)
    assert at["a", hours(20)].aqi_lag_12h == float(8 % 17)


def test_in_order_batches_do_not_read_the_table(spark, scratch, monkeypatch):
    base = [("a", h, float(h)) for h in range(100)]
    landed(spark, scratch, "t", [base])

    def fails(*_, **__):
        raise AssertionError("history was read")

    monkeypatch.setattr(jobs, "features_for_batch", fails)
    monkeypatch.setattr(jobs, "read_table", fails)
    batch = series_frame(spark, [("a", hours(100), 5.0), ("a", hours(60), 7.0)])
    schema = jobs.tails.tail_schema(batch.schema)
    work = jobs.batch_with_tails(spark, batch, f"{scratch}/t", 2, schema)
    plan = jobs.features_from_tails(work)._jdf.queryExecution().optimizedPlan().toString()
    files = work.inputFiles()
    assert plan and files and all("/t-state/tail/" in f for f in files)
    jobs.append_batch(spark, batch, 1, f"{scratch}/t")
    r = {x.timestamp: x for x in stored_rows(spark, f"{scratch}/t").collect()}
    assert len(r) == 101 and r[hours(100)].aqi_lag_3h == 97.0
    # A replay of the batch changes nothing.
    jobs.append_batch(spark, batch, 1, f"{scratch}/t")
    assert stored_rows(spark, f"{scratch}/t").count() == 101


def test_stream_after_a_bulk_load(spark, scratch):
    table = f"{scratch}/t"
    append_new(spark, add_engineered_features(series_frame(spark, [("a", hours(h), float(h)) for h in range(40)])), table)
    landed(spark, scratch, "t", [[("a", h, float(h)) for h in range(38, 45)]])
    r = {x.timestamp: x for x in stored_rows(spark, table).collect()}
    assert len(r) == 45 and r[hours(44)].aqi_lag_24h == 20.0


def test_runs_cover_every_batch_once():
    from hourcast.streaming import runs
    for n in (0, 1, 15, 16, 17, 255, 256, 300, 5000):
        covered = []
        for level, run in runs.live(n):
            size = 16**level
            covered += range(run * size, (run + 1) * size)
        assert covered == list(range(n)) and len(runs.live(n)) <= 15 * 4
    assert runs.merges(255) == [((1, 15), [(0, r) for r in range(240, 256)]), ((2, 0), [(1, r) for r in range(16)])]
