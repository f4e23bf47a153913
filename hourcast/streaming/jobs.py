"""Streaming versions of the hourly pipeline.

* :func:`hourly_aggregate_stream` -- events in any order -> mergeable partial
  states of their hours, a folder per micro-batch; reading merges them.
* :func:`distinct_event_stream` -- each event once, however late it is delivered
  again.
* :func:`feature_append_stream` -- landed hourly rows -> per micro-batch: keys not
  stored yet, with the stored rows before them (from the tails kept beside the table)
  -> engineered features -> append. Replays and duplicate rows never store a key twice.
"""

from __future__ import annotations

import os
import uuid
from datetime import timedelta
from functools import partial

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hourcast.functions.aqi import pm25_to_aqi
from hourcast.operators.joins import anti_join_new
from hourcast.operators.ordering import pick_per_group
from hourcast.operators.sinks import (DELIVERY_COLUMN, PARTITION_COLUMN, prepare_for_store, read_table, stored_between, stored_rows,
                                      write_delivery)
from hourcast.operators.windows import add_engineered_features
from hourcast.schema import RAW_COLUMNS, SERIES, TS
from hourcast.session import reliable_checkpoint, scratch_path
from hourcast.streaming import tail as tails
from hourcast.streaming.keyindex import KeyIndex

HISTORY_ROWS = 50


def run_dir(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


def partial_hours(events: DataFrame) -> DataFrame:
    """Mergeable state of each (series, hour) of some events."""
    k = F.get_json_object("props", "$.k").try_cast("double")
    hour = F.date_trunc("hour", F.col("ts").cast("timestamp_ntz"))
    got = events.groupBy(F.col("event_type").alias(SERIES), hour.alias(TS)).agg(
        F.count("*").alias("rows"), F.count("value").alias("n"), F.avg("value").alias("mean"),
        F.var_pop("value").alias("_v"), F.min("value").alias("lo"), F.max("value").alias("hi"), F.sum("value").alias("total"),
        F.count(k).alias("k_n"), F.sum(k).alias("k_total"), F.count("user_id").alias("u_n"),
        F.sum("user_id").cast("double").alias("u_total"), F.max("user_id").cast("double").alias("u_hi"))
    return got.withColumn("m2", F.col("_v") * F.col("n")).drop("_v")


def merged_hours(partials: DataFrame) -> DataFrame:
    """Hourly measures from partial states, whatever their order and number."""
    part = F.struct("n", "mean", "m2")
    got = partials.groupBy(SERIES, TS).agg(
        F.sum("rows").alias("rows"), F.sum("n").alias("n"), F.sum("total").alias("total"), F.min("lo").alias("lo"), F.max("hi").alias("hi"),
        F.sum("k_n").alias("k_n"), F.sum("k_total").alias("k_total"), F.sum("u_n").alias("u_n"), F.sum("u_total").alias("u_total"),
        F.max("u_hi").alias("u_hi"), F.collect_list(part).alias("parts"))
    got = got.withColumn("mean", F.col("total") / F.nullif("n", F.lit(0)))
    m2 = F.aggregate("parts", F.lit(0.0), lambda acc, p: acc + F.when(
        p["n"] > 0, p["m2"] + p["n"] * (p["mean"] - F.col("mean")) * (p["mean"] - F.col("mean"))).otherwise(0.0))
    std = F.when(F.col("n") > 1, F.sqrt(m2 / (F.col("n") - 1)))
    rest = [F.col("mean").alias("pm25"), F.col("hi").alias("pm10"), (F.col("k_total") / F.nullif("k_n", F.lit(0))).alias("o3"),
            std.alias("no2"), F.col("total").alias("so2"), F.col("lo").alias("co"),
            (F.col("u_total") / F.nullif("u_n", F.lit(0))).alias("temperature"), F.col("u_hi").alias("humidity"),
            F.col("rows").cast("double").alias("wind_speed")]
    got = got.select(SERIES, TS, *rest)
    return got.select(SERIES, TS, pm25_to_aqi("pm25").alias("aqi"), *[c for c in got.columns if c not in (SERIES, TS)])


def event_reader(spark: SparkSession, source: str, schema, max_files: int, name_glob: str | None):
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
    return (reader.option("pathGlobFilter", name_glob) if name_glob else reader).parquet(source)


def hourly_aggregate_stream(spark: SparkSession, source: str, schema, out: str, checkpoint: str,
                            max_files: int = 64, name_glob: str | None = None):
    """Events in any order: each micro-batch writes the partial states of its hours
    to a folder of its own (a replay rewrites it); reading merges them.  No
    watermark, so no event is ever late."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        partial_hours(batch).write.mode("overwrite").parquet(os.path.join(out, f"batch={batch_id}"))

    events = event_reader(spark, source, schema, max_files, name_glob)
    return events.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_hourly_aggregate(spark: SparkSession, out: str) -> DataFrame:
    """Hourly measures over all micro-batches."""
    return merged_hours(spark.read.parquet(out))


def distinct_event_stream(spark: SparkSession, source: str, schema, out: str, checkpoint: str, key: str = "event_id",
                          max_files: int = 64):
    """Each event once, however often and late it is delivered again and whatever its stamp
    then says: a micro-batch stores the events whose key no earlier batch stored. Keys
    are looked up in an index beside the table (:mod:`hourcast.streaming.keyindex`). Events
    without a key are all stored. A replay rewrites its batch's events and index run."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        index = KeyIndex(spark, f"{out}-keys", key, dict(batch.dtypes)[key])
        keyed = pick_per_group(batch.filter(F.col(key).isNotNull()), [key], [F.col("ts")]).select(*batch.columns)
        once = keyed.unionByName(batch.filter(F.col(key).isNull())).persist()
        try:
            seen = index.seen(once, batch_id)
            new = once if seen is None else once.join(seen, key, "left_anti")
            day = F.date_format(F.col("ts").cast("timestamp_ntz"), "yyyy-MM-dd")
            new.withColumns({"day": day, "batch": F.lit(batch_id)}).write.mode("overwrite").option(
                "partitionOverwriteMode", "dynamic").partitionBy("batch", "day").parquet(out)
            index.add(new, batch_id)
        finally:
            once.unpersist()

    events = event_reader(spark, source, schema, max_files, None)
    return events.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


RECENT_DAYS = 62


def history_before(stored: DataFrame, bounds: DataFrame, rows: int) -> DataFrame:
    """The newest ``rows`` stored rows of each series before its first new row."""
    w = Window.partitionBy(SERIES).orderBy(F.col(TS).desc())
    before = stored.join(bounds, SERIES).filter(F.col(TS) < F.col("_lo"))
    return before.withColumn("_rk", F.row_number().over(w)).filter(F.col("_rk") <= rows).drop("_rk", "_lo", "_hi")


def features_for_batch(spark: SparkSession, batch: DataFrame, table: str, recent_days: int = RECENT_DAYS,
                       stored_filter=None) -> DataFrame:
    """Features of the batch's new rows, one for each key that is not stored yet
    (``stored_filter`` restricts which stored rows count).

    Each series gets the ``HISTORY_ROWS`` stored rows before its first new row and
    the stored rows up to its last one, so late rows have their own past.  The
    months of ``recent_days`` are read first; older ones only for series that
    have too few rows in them, without any limit of age.  As in the batch job,
    the rows are taken first and those without a target dropped after."""
    stored = read_table(spark, table)
    if stored is not None and stored_filter is not None:
        stored = stored.filter(stored_filter)
    raw_cols = [c for c in RAW_COLUMNS if c in batch.columns]
    new = pick_per_group(batch.select(SERIES, *raw_cols), [SERIES, TS], [F.col(c) for c in raw_cols if c != TS])
    if stored is None:
        return add_engineered_features(reliable_checkpoint(new), strategy="plain")
    span = new.agg(F.min(TS).alias("lo"), F.max(TS).alias("hi")).first()
    if span.lo is None:
        return new.limit(0)
    near = stored_between(stored, span.lo, span.hi)
    new = reliable_checkpoint(anti_join_new(new, near, [SERIES, TS]))
    bounds = new.groupBy(SERIES).agg(F.min(TS).alias("_lo"), F.max(TS).alias("_hi"))
    since = span.lo - timedelta(days=recent_days)
    kept = stored.select(SERIES, *raw_cols, PARTITION_COLUMN)
    recent = reliable_checkpoint(history_before(stored_between(kept, since, span.hi), bounds, HISTORY_ROWS))
    short = bounds.join(recent.groupBy(SERIES).count().filter(F.col("count") >= HISTORY_ROWS), SERIES, "left_anti")
    past = recent
    if not short.isEmpty():
        older = kept.filter((F.col(PARTITION_COLUMN) <= F.lit(f"{since:%Y-%m}")) & (F.col(TS) < F.lit(since)))
        past = history_before(older.join(short.select(SERIES), SERIES, "left_semi").unionByName(
            recent.join(short.select(SERIES), SERIES, "left_semi")), bounds, HISTORY_ROWS).unionByName(
            recent.join(short.select(SERIES), SERIES, "left_anti"))
    within = near.select(SERIES, *raw_cols).join(bounds, SERIES).filter((F.col(TS) >= F.col("_lo")) & (F.col(TS) <= F.col("_hi")))
    past = past.select(SERIES, *raw_cols).unionByName(within.select(SERIES, *raw_cols)).filter(F.col("aqi").isNotNull())
    # A series has its 50 rows and the batch's here: bounded, so no size is measured.
    feats = add_engineered_features(reliable_checkpoint(past.unionByName(new)), strategy="plain")
    return feats.join(new.select(SERIES, TS), [SERIES, TS], "left_semi")


def batch_with_tails(spark: SparkSession, batch: DataFrame, table: str, batch_id: int, schema) -> DataFrame:
    """A row per series of the batch: tail (its newest stored rows), fresh (its rows that are
    not stored yet, by time) and ``known`` (the tail holds all the past they need)."""
    names = [f.name for f in schema["tail"].dataType.elementType.fields]
    fresh = pick_per_group(batch.select(SERIES, *names), [SERIES, TS], [F.col(c) for c in names if c != TS])
    fresh = fresh.groupBy(SERIES).agg(F.array_sort(F.collect_list(F.struct(*names))).alias("fresh"))
    state = tails.current(spark, f"{table}-state", batch_id, schema)
    both = fresh.join(state, SERIES, "left")
    none = F.array().cast(schema["tail"].dataType)
    both = both.withColumn("tail", F.coalesce("tail", none))
    both = both.withColumn("fresh", F.filter("fresh", lambda f: ~F.exists("tail", lambda t: t[TS] == f[TS])))
    first = F.get("fresh", F.lit(0))[TS]
    # All stored rows, or enough of them before the first new one.
    whole = F.size("tail") < tails.TAIL_ROWS
    return both.withColumn("known", whole | (F.size(F.filter("tail", lambda t: t[TS] < first)) >= HISTORY_ROWS))


def features_from_tails(work: DataFrame) -> DataFrame:
    """Features of the fresh rows of the series whose tails hold their past: as
    :func:`features_for_batch`, without a read of the table."""
    first, last = F.get("fresh", F.lit(0))[TS], F.element_at("fresh", -1)[TS]
    before = F.filter("tail", lambda t: t[TS] < first)
    before = F.slice(before, F.greatest(F.size(before) - HISTORY_ROWS + 1, F.lit(1)), F.lit(HISTORY_ROWS))
    within = F.filter("tail", lambda t: (t[TS] >= first) & (t[TS] <= last))
    past = F.filter(F.concat(before, within), lambda t: t["aqi"].isNotNull())

    def marked(rows, new: bool):
        return F.transform(rows, lambda r: F.struct(r.alias("r"), F.lit(new).alias("new")))

    rows = work.filter(F.col("known") & (F.size("fresh") > 0)).select(SERIES, F.explode(F.concat(marked(past, False), marked(F.col("fresh"), True))).alias("e"))
    feats = add_engineered_features(rows.select(SERIES, "e.r.*", F.col("e.new").alias("_new")), strategy="plain")
    return feats.filter("_new").drop("_new")


def append_batch(spark: SparkSession, batch: DataFrame, batch_id: int, table: str) -> None:
    """Append the features of a micro-batch's new rows, as a delivery of its own that a replay
    replaces. Series that go on where they ended get their past from the tails; the
    table's history is read only for series with rows older than their tails reach."""
    raw = [c for c in RAW_COLUMNS if c in batch.columns]
    schema = tails.tail_schema(batch.select(SERIES, *raw).schema)
    if batch_id == 0 and (stored := read_table(spark, table)) is not None:
        # The table has rows from elsewhere: their tails are run (0, 0), before any batch's.
        stored = stored.filter(F.col(DELIVERY_COLUMN) != "batch-0") if DELIVERY_COLUMN in stored.columns else stored
        tails.store(spark, f"{table}-state", 0, tails.from_table(stored, schema), schema)
    number = batch_id + 1
    work = reliable_checkpoint(batch_with_tails(spark, batch, table, number, schema))
    feats = prepare_for_store(features_from_tails(work))
    late = work.filter(~F.col("known") & (F.size("fresh") > 0)).select(SERIES, F.explode("fresh").alias("r")).select(SERIES, "r.*")
    delivery = f"batch-{batch_id}"
    if not late.isEmpty():
        own = F.col(DELIVERY_COLUMN) != delivery
        feats = feats.unionByName(prepare_for_store(features_for_batch(spark, late, table, stored_filter=own)))
    write_delivery(feats, table, delivery)
    merged = F.array_sort(F.concat("tail", "fresh"))
    newest = F.slice(merged, F.greatest(F.size(merged) - tails.TAIL_ROWS + 1, F.lit(1)), F.lit(tails.TAIL_ROWS))
    tails.store(spark, f"{table}-state", number, work.select(SERIES, newest.alias("tail")), schema)


def feature_append_stream(spark: SparkSession, source: str, schema, table: str, checkpoint: str,
                          max_files: int = 1):
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(source)
    sink = partial(_append_sink, spark=spark, table=table)
    return (rows.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def _append_sink(batch: DataFrame, batch_id: int, spark: SparkSession, table: str) -> None:
    append_batch(spark, batch, batch_id, table)


def time_pieces(df: DataFrame, pieces: int, ts=TS) -> list[DataFrame]:
    """``df`` cut into ``pieces`` time ranges of equal length."""
    span = df.agg(F.min(ts).alias("lo"), F.max(ts).alias("hi")).first()
    if span.lo is None:
        return [df]
    cuts = [span.lo + (span.hi - span.lo) * i / pieces for i in range(1, pieces)]
    edges = [None, *cuts, None]
    return [df.filter((F.lit(True) if lo is None else F.col(ts) >= F.lit(lo)) & (F.lit(True) if hi is None else F.col(ts) < F.lit(hi)))
            for lo, hi in zip(edges[:-1], edges[1:])]


def run_feature_append(spark: SparkSession, hourly: DataFrame, pieces: int = 6) -> DataFrame:
    """The feature table after ``pieces`` deliveries of landed hours, one run of the
    stream after each; a delivery has as many files as its tasks write."""
    base = run_dir(spark, "feature-append")
    landing, table, ckpt = (os.path.join(base, p) for p in ("landing", "table", "checkpoint"))
    for piece in time_pieces(hourly, pieces):
        piece.write.mode("append").parquet(landing)
        feature_append_stream(spark, landing, hourly.schema, table, ckpt, max_files=1000).awaitTermination()
    return stored_rows(spark, table)


def run_hourly_aggregate(spark: SparkSession, events_path: str, files: int = 8) -> DataFrame:
    """Hourly measures of the events, landed as ``files`` files without any order."""
    base = run_dir(spark, "hourly-aggregate")
    landing, out, ckpt = (os.path.join(base, p) for p in ("landing", "out", "checkpoint"))
    events = spark.read.parquet(events_path)
    events.repartition(files, "event_id").write.parquet(landing)
    hourly_aggregate_stream(spark, landing, events.schema, out, ckpt, max_files=2).awaitTermination()
    return read_hourly_aggregate(spark, out)


def run_hourly_aggregate_redelivered(spark: SparkSession, events_path: str, copies: int = 2, files: int = 8) -> DataFrame:
    """Every event landed ``copies`` times, in files without any order; the stream
    keeps one of each ``event_id``."""
    base = run_dir(spark, "hourly-dedupe")
    landing, out, ckpt = (os.path.join(base, p) for p in ("landing", "out", "checkpoint"))
    events = spark.read.parquet(events_path)
    again = events.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
    again.repartition(files, "event_id", "_copy").drop("_copy").write.parquet(landing)
    distinct_event_stream(spark, landing, events.schema, out, ckpt, max_files=2).awaitTermination()
    return merged_hours(partial_hours(spark.read.parquet(out)))
