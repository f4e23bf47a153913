"""SparkSession construction and cluster-shared settings."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every hourcast job relies on. Session time zone is pinned to UTC so
# hour/day extraction is identical on every executor.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "hourcast",
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's shared ``spark.checkpoint.dir``; only when it is unset
    (local tests) create a private one."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="hourcast-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for lineage-cutting tables written by hourcast jobs."""
    return ensure_checkpoint_dir(spark).rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return os.path.join(checkpoint_root(spark), "hourcast", name)


def reliable_checkpoint(df):
    """``df.checkpoint(eager=True)`` into the session's shared checkpoint folder
    (made sure to be configured first)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
