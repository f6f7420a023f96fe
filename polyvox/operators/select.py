"""Statement selection by agreeability."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from polyvox.functions.exprs import argument_budget
from polyvox.operators.rank import running
from polyvox.operators.skew import per_dataset, per_topic, salted_join


def accepted(comments: DataFrame) -> DataFrame:
    """C2."""
    return comments.filter(F.col("moderated") == 1)


def not_rejected(comments: DataFrame) -> DataFrame:
    """Accepted and unmoderated."""
    return comments.filter(F.col("moderated") >= 0)


def group_quantile(df: DataFrame, keys: list[str], col: str, q: float) -> DataFrame:
    """Exact linear-interpolated quantile of ``col`` per group -> (keys..., __t).

    Rows are first counted per distinct value (map-side combine), so a group
    of any size moves only its distinct values; a running count over them,
    range-partitioned (``rank.running``), finds the two values around position
    q * (n - 1), so no task sees all values of a large group."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(*keys, F.col(col).alias("__v")).agg(F.count("*").alias("__n"))
    seen = running(counts, keys, ["__v"], "__seen", "__n")
    at = F.lit(q) * (F.col("__all") - 1)
    total = seen.groupBy(*keys).agg(F.sum("__n").alias("__all")).withColumns({"__at": at, "__low": F.floor(at), "__high": F.ceil(at)})
    placed = salted_join(seen, total, keys, ["__v"])
    low = F.min(F.when(F.col("__seen") > F.col("__low"), F.col("__v")))
    high = F.min(F.when(F.col("__seen") > F.col("__high"), F.col("__v")))
    return placed.groupBy(*keys).agg((low + (high - low) * F.max(F.col("__at") - F.col("__low"))).alias("__t"))


def _thresholds(df: DataFrame, keys: list[str], q: float, method: str) -> DataFrame:
    if method == "linear":
        return group_quantile(df, keys, "agreeability", q)
    if method == "disc":
        agg = F.expr(f"percentile_disc({q}) WITHIN GROUP (ORDER BY agreeability)")
    elif method == "approx":
        agg = F.percentile_approx("agreeability", q, 10000)
    else:
        raise ValueError(method)
    return df.groupBy(*keys).agg(agg.alias("__t"))


def agreeable_comments(comments: DataFrame, quantile: float | None = 0.1,
                       threshold: float | None = None, method: str = "linear") -> DataFrame:
    """C4: accepted statements with agreeability >= t, per dataset.

    ``t`` is the ``quantile`` of accepted agreeability (wins when given) or
    the fixed ``threshold``. The quantile is one aggregate row per dataset,
    joined back (a tiny, dataset-count-sized side).
    """
    acc = accepted(comments)
    if quantile is None and threshold is None:
        return acc
    if quantile is None:
        return acc.filter(F.col("agreeability") >= threshold)
    th = _thresholds(acc, ["dataset"], quantile, method)
    return acc.join(per_dataset(th), "dataset").filter(F.col("agreeability") >= F.col("__t")).drop("__t")


def topic_comments(comments: DataFrame, quantile: float | None = None,
                   threshold: float | None = None, method: str = "linear") -> DataFrame:
    """Accepted statements per topic above a fixed threshold (wins) or the
    topic's own agreeability quantile; all topics in one pass."""
    acc = accepted(comments)
    if threshold is not None:
        return acc.filter(F.col("agreeability") >= threshold)
    if quantile is None:
        return acc
    th = _thresholds(acc, ["dataset", "topicId"], quantile, method)
    return (acc.join(per_topic(th), ["dataset", "topicId"])
            .filter(F.col("agreeability") >= F.col("__t")).drop("__t"))


def of_topic(df: DataFrame, topic_id: int, argument_id: int | None = None, topic: str = "topicId") -> DataFrame:
    """C7 + C13: rows of one topic, and of one argument of it if given."""
    cond = F.col(topic) == topic_id
    return df.filter(cond if argument_id is None else cond & (F.col("argumentId") == argument_id))


def exactly_one(keys: DataFrame, table: DataFrame, on: list[str]) -> DataFrame:
    """For each row of ``keys`` its one row of ``table``; a key without a row, or with more
    than one, raises. All keys are looked up in one join."""
    n = table.join(keys.select(*on).distinct(), on, "left_semi").groupBy(*on).agg(F.count("*").alias("__n"))
    found = keys.join(n, on, "left")
    wrong = F.raise_error(F.concat(F.lit("expected one row, found "), F.coalesce("__n", F.lit(0)).cast("string")))
    checked = found.filter(F.when(F.coalesce("__n", F.lit(0)) == 1, True).otherwise(wrong.cast("boolean"))).drop("__n")
    return checked.join(table, on)


def topic_range(df: DataFrame, topic: str = "topicId") -> DataFrame:
    """Smallest and largest topic id per dataset, and the next free id."""
    return (df.groupBy("dataset").agg(F.min(topic).alias("first"), F.max(topic).alias("last"))
            .withColumn("next", F.col("last") + 1))


def best_first(comments: DataFrame, above: float) -> DataFrame:
    """Accepted statements with agreeability > ``above``, best first
    within each topic. A global range-partitioned sort, not a per-topic
    window, so one large topic does not land in one task."""
    return (accepted(comments).filter(F.col("agreeability") > above)
            .orderBy("dataset", "topicId", F.desc("agreeability"), "commentId"))


def budget_per_topic(agreeable: DataFrame) -> DataFrame:
    """E4 + I6 + E9: agreeable statements per topic, the argument budget
    ceil(2 ln n), and the dataset's total budget."""
    per_topic = agreeable.groupBy("dataset", "topicId").agg(F.count("*").alias("n"))
    return (per_topic.withColumn("budget", argument_budget("n"))
            .withColumn("total_budget",
                        F.sum("budget").over(Window.partitionBy("dataset")).cast("bigint")))
