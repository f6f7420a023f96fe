"""Ranks and running sums of groups of any size.

A window over a group puts the group into one task. Here rows are range-partitioned by (keys, order), so a
large group spans many partitions; each partition's share of a group is summed, the sums of the partitions
before it are its offset, and a window over (keys, partition) adds the position inside it. The rows
are written once between the two passes, which so see the same partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from polyvox.sources.store import staged

_PART = "__part"


def running(df: DataFrame, keys: list[str], order: list[str | Column], name: str, value: str | None = None) -> DataFrame:
    """``df`` with column ``name``: per group of ``keys`` the row's position (from 1) in ``order``, which must be
    total, or with ``value`` the sum of that column up to and including the row."""
    what = F.col(value) if value else F.lit(1).cast("bigint")
    rows = staged(df.repartitionByRange(*keys, *order).withColumn(_PART, F.spark_partition_id()), "ranked")
    shares = rows.groupBy(*keys, _PART).agg(F.sum(what).alias("__share"))
    # a row per group and partition that it reaches into
    before = Window.partitionBy(*keys).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = shares.select(*keys, _PART, F.coalesce(F.sum("__share").over(before), F.lit(0)).alias("__offset"))
    inside = Window.partitionBy(*keys, _PART).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (rows.withColumn(name, F.sum(what).over(inside)).join(offsets, [*keys, _PART])
            .withColumn(name, F.col(name) + F.col("__offset")).drop(_PART, "__offset"))
