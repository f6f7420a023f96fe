"""Argument/statement edge operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polyvox.operators.skew import topic_join


def related(edges: DataFrame) -> DataFrame:
    """C10."""
    return edges.filter(F.col("relationship") != "UNRELATED")


def topic_pairs(statements: DataFrame, arguments: DataFrame) -> DataFrame:
    """Every statement with every argument of its topic.

    An equi-join on (dataset, topicId). A topic holding a large share of the
    statements is split by statement hash (``topic_join``), the arguments of
    that topic being copied to each split."""
    s = statements.select("dataset", "topicId", "commentId")
    a = arguments.select("dataset", "topicId", "argumentId")
    return topic_join(s, a)


def pair_count(statements: DataFrame, arguments: DataFrame) -> DataFrame:
    """D6 + E8: sum over topics of n_statements x n_arguments, per dataset.

    Both sides are pre-aggregated to one row per topic before the join."""
    s = statements.groupBy("dataset", "topicId").agg(F.count("*").alias("n_s"))
    a = arguments.groupBy("dataset", "topicId").agg(F.count("*").alias("n_a"))
    return (s.join(a, ["dataset", "topicId"])
            .groupBy("dataset").agg(F.sum(F.col("n_s") * F.col("n_a")).cast("bigint").alias("pairs")))


def relationship_counts(edges: DataFrame) -> DataFrame:
    """E5."""
    return edges.groupBy("dataset", "relationship").agg(F.count("*").alias("count"))


def edges_by_topic_argument(edges: DataFrame) -> DataFrame:
    """C10 + E6."""
    return (related(edges).groupBy("dataset", "topicId", "argumentId", "relationship")
            .agg(F.count("commentId").alias("count")))


def edges_topic_histogram(edges: DataFrame) -> DataFrame:
    """C10 + E7: edge counts by topic x relationship, SUPPORT/REFUTE side by side."""
    return (related(edges).groupBy("dataset", "topicId")
            .agg(F.count_if(F.col("relationship") == "SUPPORT").alias("SUPPORT"),
                 F.count_if(F.col("relationship") == "REFUTE").alias("REFUTE")))


def comments_per_argument(edges: DataFrame, arguments: DataFrame) -> DataFrame:
    """E11 + D10: supporting statements of each argument, in long form.

    The reference's list per argument is kept as (argument, commentId, n)
    rows instead of one array, so a heavily supported argument is never
    gathered into one row; order by (argument, commentId) for the list."""
    sup = edges.filter(F.col("relationship") == "SUPPORT").select(
        "dataset", "topicId", "argumentId", "commentId")
    n = sup.groupBy("dataset", "topicId", "argumentId").agg(F.count("*").alias("n_comments"))
    return (sup.join(arguments.select("dataset", "topicId", "argumentId", "argumentTitle"),
                     ["dataset", "topicId", "argumentId"], "left")
            .join(n, ["dataset", "topicId", "argumentId"]))


def supporting_comments(edges: DataFrame, comments: DataFrame) -> DataFrame:
    """E15 + D9: distinct statements that support any argument, with text and tallies."""
    ids = (edges.filter(F.col("relationship") == "SUPPORT")
           .select("dataset", "commentId").distinct())
    return ids.join(comments.select("dataset", "commentId", "commentText", "agrees",
                                    "disagrees", "agreeability"),
                    ["dataset", "commentId"], "left")
