"""Dataset reports and table utilities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dataset_overview(summary: DataFrame, comments: DataFrame, votes: DataFrame) -> DataFrame:
    """E17 + K6: per dataset: title, description, url, participants,
    comments, accepted comments.

    ``count_distinct`` of voters is planned as a two-level aggregate
    (dataset, voter) then dataset, so it is not gathered into one task."""
    info = (summary.groupBy("dataset")
            .pivot("key", ["topic", "conversation-description", "url"])
            .agg(F.first("value"))
            .withColumnRenamed("conversation-description", "description"))
    c = comments.groupBy("dataset").agg(F.count("*").alias("comments"),
                                        F.count_if(F.col("moderated") == 1).alias("accepted"))
    p = votes.groupBy("dataset").agg(F.count_distinct("voterId").alias("participants"))
    return info.join(c, "dataset", "left").join(p, "dataset", "left")


def profile(df: DataFrame, cols: list[str] | None = None, approx: bool = False) -> DataFrame:
    """One pass over ``df``: rows, nulls, min, max, distinct per column,
    in long form (column, rows, nulls, min, max, distinct). ``approx`` uses
    HyperLogLog++ for the distinct count (bounded memory, one pass however many
    columns; exact distinct counts repeat the rows once per column)."""
    cols = cols or df.columns
    distinct = F.approx_count_distinct if approx else F.count_distinct
    aggs = [F.count("*").alias("__rows")]
    for c in cols:
        aggs += [F.count_if(F.col(c).isNull()).alias(f"{c}__nulls"),
                 F.min(c).cast("string").alias(f"{c}__min"),
                 F.max(c).cast("string").alias(f"{c}__max"),
                 distinct(c).alias(f"{c}__distinct")]
    one = df.agg(*aggs)
    stacked = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col("__rows").alias("rows"),
                 F.col(f"{c}__nulls").alias("nulls"), F.col(f"{c}__min").alias("min"),
                 F.col(f"{c}__max").alias("max"), F.col(f"{c}__distinct").alias("distinct"))
        for c in cols]))
    return one.select(stacked.alias("__p")).select("__p.*")


def replace_partitions(base: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """G2 (many partitions at once): drop every ``keys`` group of ``base`` that
    ``new`` has, then append ``new``. Storage form: dynamic partition
    overwrite of the same groups."""
    done = new.select(*keys).distinct()
    return base.join(done, keys, "left_anti").unionByName(new)


def rows_from_lists(lists: DataFrame, keys: list[str], titles: str, contents: str,
                    start: int = 0) -> DataFrame:
    """One row per (title, content) pair of two parallel arrays, with
    ``argumentId`` numbered from ``start``. Unequal lengths raise, as the
    reference's length check does."""
    checked = lists.withColumn(
        "__ok", F.when(F.size(titles) == F.size(contents), F.lit(True))
        .otherwise(F.raise_error(F.lit("titles and contents differ in length"))))
    return (checked.filter("__ok")
            .select(*keys, F.posexplode(F.arrays_zip(F.col(titles).alias("t"),
                                                     F.col(contents).alias("c"))))
            .select(*keys, (F.col("pos") + start).cast("bigint").alias("argumentId"),
                    F.col("col.t").alias("argumentTitle"), F.col("col.c").alias("argumentContent")))


def first_rows(df: DataFrame, order: list, n: int = 20) -> DataFrame:
    """first ``n`` rows by ``order`` (a top-k: TakeOrderedAndProject)."""
    return df.orderBy(*order).limit(n)
