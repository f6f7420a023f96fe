"""Spark session defaults and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on. Cluster-specific sizing (executor memory,
# shuffle partitions at 100 TB) comes from the cluster's own config; AQE
# coalesces and splits partitions at runtime so one default serves all sizes.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "4096",
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = None, app: str = "polyvox",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the defaults above.

    ``master`` is only set for local runs (tests, bench); on a cluster the
    submitter decides it.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
        b = b.config("spark.driver.memory", os.environ.get("POLYVOX_DRIVER_MEM", "16g"))
    for k, v in SESSION_DEFAULTS.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for ``checkpoint()`` and intermediate tables.

    Read from ``spark.checkpoint.dir`` (the cluster names a shared, durable
    folder there). Only a local-mode session without the setting (tests,
    bench) gets a fresh scratch folder; a cluster session without it is an
    error, because a machine-local folder would not survive executor loss.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder for iterative jobs")
    path = tempfile.mkdtemp(prefix="polyvox-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()
