"""Index of the keys that a stream has stored, looked up whatever the age of a key.

A run (see :mod:`hourcast.streaming.runs`) holds its keys in hash buckets, and a summary:
for each fine bucket of about ``BUCKET_KEYS`` keys the least and largest key, their
number, and a Bloom filter of ``BITS`` bits, built and tested with Spark's bitmap functions. A
lookup joins the new keys with the summaries on the bucket, keeps what passes the range and
the filter, and reads only the key buckets that are then left: none for keys never seen,
but for the filter's false positives (1.4 % at a full bucket)."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourcast.streaming import runs

BUCKET_KEYS = 3000
BITS = 32_768        # of one bitmap in Spark's bitmap functions
HASHES = 3
FOLDERS = 1024       # most key folders of a run
PRUNE_FOLDERS = 4096  # folders that a lookup names one by one


def _bucket(key: Column, n: Column) -> Column:
    return F.pmod(F.xxhash64(key), n)


def _positions(key: Column) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(i + 1)), F.lit(BITS)).cast("int") for i in range(HASHES)]


def _bit(bloom: Column, at: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bloom, F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.floor(byte / F.pow(F.lit(2), at % 8)) % 2 == 1


class KeyIndex:
    def __init__(self, spark: SparkSession, root: str, key: str, key_type: str):
        self.spark, self.root, self.key, self.key_type = spark, root, key, key_type

    def _summaries(self, live) -> DataFrame:
        schema = f"buckets long, bucket long, lo {self.key_type}, hi {self.key_type}, n long, bloom binary, level int, run int"
        return runs.read(self.spark, self.root, "summary", live, schema)

    def candidates(self, keys: DataFrame, batch: int) -> DataFrame:
        """(key, level, run, folder): where the runs before ``batch`` may hold a key."""
        s = self._summaries(runs.live(batch))
        sizes = [r.buckets for r in s.select("buckets").distinct().collect()]  # powers of two
        k = F.col(self.key)
        asked = keys.select(self.key).filter(k.isNotNull()).withColumn("buckets", F.explode(F.array(*[F.lit(n).cast("long") for n in sizes])))
        asked = asked.withColumn("bucket", _bucket(k, F.col("buckets")))
        hit = asked.join(s, ["buckets", "bucket"]).filter((F.col("lo") <= k) & (k <= F.col("hi")))
        for at in _positions(k):
            hit = hit.filter(_bit(F.col("bloom"), at))
        return hit.select(self.key, "level", "run", F.pmod("bucket", F.lit(FOLDERS)).alias("folder"))

    def held_keys(self, found: DataFrame, batch: int) -> DataFrame | None:
        """The keys in the folders that ``found`` names (None: no folder)."""
        where = found.select("level", "run", "folder").distinct().limit(PRUNE_FOLDERS + 1).collect()
        if not where:
            return None
        base = os.path.join(self.root, "keys")
        paths = [os.path.join(runs.folder(self.root, "keys", (r.level, r.run)), f"folder={r.folder}") for r in where]
        if len(paths) > PRUNE_FOLDERS:
            paths = [runs.folder(self.root, "keys", r) for r in runs.live(batch)]
        schema = f"{self.key} {self.key_type}, level int, run int, folder long"
        return self.spark.read.option("basePath", base).schema(schema).parquet(*paths).select(self.key)

    def seen(self, keys: DataFrame, batch: int) -> DataFrame | None:
        """Those of ``keys`` that the runs before ``batch`` hold (None: none may be held)."""
        if not runs.live(batch):
            return None
        found = self.candidates(keys, batch).persist()
        try:
            held = self.held_keys(found, batch)
            if held is None:
                return None
            out = held.join(found.select(self.key).distinct(), self.key, "left_semi").distinct()
            from hourcast.session import reliable_checkpoint
            return reliable_checkpoint(out)
        finally:
            found.unpersist()

    def _write(self, keys: DataFrame, run: tuple[int, int]) -> None:
        n = keys.count()
        buckets = 1
        while buckets * BUCKET_KEYS < n:
            buckets *= 2
        k = F.col(self.key)
        rows = keys.select(self.key).withColumn("bucket", _bucket(k, F.lit(buckets)))
        held = rows.select(self.key, F.pmod("bucket", F.lit(FOLDERS)).alias("folder"))
        held.repartition("folder").write.mode("overwrite").partitionBy("folder").parquet(runs.folder(self.root, "keys", run))
        each = rows.select(self.key, "bucket", F.explode(F.array(*_positions(k))).alias("at"))
        summary = each.groupBy("bucket").agg(F.min(self.key).alias("lo"), F.max(self.key).alias("hi"),
                                             F.floor(F.count(F.lit(1)) / HASHES).alias("n"), F.bitmap_construct_agg("at").alias("bloom"))
        summary.select(F.lit(buckets).cast("long").alias("buckets"), "bucket", "lo", "hi", "n", "bloom").write.mode("overwrite").parquet(
            runs.folder(self.root, "summary", run))

    def add(self, keys: DataFrame, batch: int) -> None:
        """Store the new keys of ``batch`` and do the merges it completes."""
        self._write(keys.select(self.key).filter(F.col(self.key).isNotNull()), (0, batch))
        schema = f"{self.key} {self.key_type}, folder long, level int, run int"
        for run, parts in runs.merges(batch):
            self._write(runs.read(self.spark, self.root, "keys", parts, schema).select(self.key), run)
