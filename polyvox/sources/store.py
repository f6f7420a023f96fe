"""Intermediate tables written to the shared checkpoint folder.

Like the reference pipeline, each stage's table (votes, comments, topics,
arguments, edges, ...) is written once and read back by later stages: the
lineage is cut, a lost executor only re-reads parquet, and later plans stay
small. Tables live under ``{spark.checkpoint.dir}/polyvox-tables`` (a shared,
durable folder on a cluster) and are remembered per session.
"""

from __future__ import annotations

import hashlib
import re
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession

from polyvox.session import checkpoint_dir

_LOCK = threading.Lock()
_TABLES: dict[tuple[str, str, str], tuple[str, bool]] = {}


def _key(spark: SparkSession, scope: str) -> str:
    return hashlib.sha1(f"{spark.sparkContext.applicationId}|{scope}".encode()).hexdigest()[:16]


def materialize(spark: SparkSession, scope: str, name: str, build, base: bool = True,
                partition_by: list[str] | None = None) -> DataFrame:
    """Write ``build()`` once per (session, scope, name) and return a scan of it.

    ``base`` marks pipeline tables (kept for the session); other entries
    are query intermediates that ``forget_intermediates`` drops (bench)."""
    app = spark.sparkContext.applicationId
    k = (app, scope, name)
    with _LOCK:
        hit = _TABLES.get(k)
    if hit is None:
        path = f"{checkpoint_dir(spark).rstrip('/')}/polyvox-tables/{_key(spark, scope)}/{name}"
        w = build().write.mode("overwrite").option("compression", "zstd")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(path)
        with _LOCK:
            _TABLES[k] = (path, base)
        hit = (path, base)
    return spark.read.parquet(hit[0])


def forget_intermediates(spark: SparkSession | None = None, all_tables: bool = False) -> None:
    """Forget query intermediates (and with ``all_tables`` the base tables
    too) so the next call recomputes them."""
    with _LOCK:
        for k in list(_TABLES):
            if all_tables or not _TABLES[k][1]:
                del _TABLES[k]


def staged(df: DataFrame, name: str, per_file: int | None = None) -> DataFrame:
    """Write ``df`` to a new folder below the shared checkpoint folder and scan it. Lineage ends there, and
    unlike ``checkpoint()`` so do the planner's size estimates, which joins in a loop would otherwise
    multiply round by round until planning takes longer than the work. ``per_file`` bounds a file's rows where
    a row is so large that a reader's batch of them must stay small."""
    root = re.sub(r"^file:/+", "file:///", checkpoint_dir(df.sparkSession).rstrip("/"))
    path = f"{root}/polyvox-stages/{name}-{uuid.uuid4().hex[:16]}"
    w = df.write.option("compression", "zstd")
    (w.option("maxRecordsPerFile", per_file) if per_file else w).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
