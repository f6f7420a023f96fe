"""Argument maps as ordered text tables.

A map is a table ``(dataset, section, k1..k6, text)``: concatenating
``text`` in key order gives the Argdown document of the reference
(front matter, heading, topics, arguments, comments, links). Rows are built
with column expressions, sorted by a range-partitioned sort and written by
many tasks (``write_maps``) — no document is assembled in one place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polyvox.functions import argdown as A
from polyvox.functions.exprs import agreeability
from polyvox.operators.scoring import supporting, top_arguments, top_comments

KEYS = ["section", "k1", "k2", "k3", "k4", "k5", "k6"]


def _row(df: DataFrame, section: int, text, *keys) -> DataFrame:
    ks = list(keys) + [F.lit(0.0)] * (6 - len(keys))
    return df.select("dataset", F.lit(section).alias("section"),
                     *[k.cast("double").alias(f"k{i + 1}") for i, k in enumerate(ks)],
                     text.alias("text"))


def _frame(summary: DataFrame) -> list[DataFrame]:
    """Front matter (section -1), heading (0) and the closing newline (99)."""
    info = (summary.groupBy("dataset")
            .agg(F.max(F.when(F.col("key") == "topic", F.col("value"))).alias("title"),
                 F.max(F.when(F.col("key") == "conversation-description", F.col("value")))
                 .alias("description")))
    head = F.when(F.col("description").isNull(), A.heading(F.col("title"))).otherwise(
        A.heading(F.col("title"), F.col("description")))
    return [_row(info, -1, F.lit(A.template_head())), _row(info, 0, head),
            _row(info, 99, F.lit("\n"))]


def _topics(ats: DataFrame, topics: DataFrame) -> DataFrame:
    ids = ats.select("dataset", "topicId").distinct()
    t = topics.select("dataset", F.col("Topic").alias("topicId"), "Title", "Heading")
    return _row(ids.join(t, ["dataset", "topicId"], "left"), 1,
                A.topic(F.col("Heading"), F.col("Title")), F.col("topicId"))


def _neg(x) -> F.Column:
    """Descending key with NULL last for values in [0, inf)."""
    return F.coalesce(-x.cast("double"), F.lit(float("inf")))


def top_map(summary: DataFrame, topics: DataFrame, edges: DataFrame, comments: DataFrame,
            ats: DataFrame, n_arguments: int = 3, n_comments: int = 3) -> DataFrame:
    """K2: heading, topics, the top ``n_arguments`` arguments per topic linked
    to the topic heading, and the top ``n_comments`` supporting comments per
    top argument linked to the argument."""
    top = top_arguments(ats, n_arguments)
    best = top.groupBy("dataset", "topicId").agg(F.max("agreeability").alias("__best"))
    args = top.join(best, ["dataset", "topicId"])
    body = F.concat(F.col("argumentContent"), F.lit(" _("),
                    (F.col("agrees") + F.col("disagrees")).cast("string"),
                    F.lit(" voters approximated, "), A.pct(F.col("agreeability")),
                    F.lit("% tend to agree_)"))
    arg_rows = _row(args, 2, A.argument(F.col("argumentTitle"), body, F.col("topicHeading")),
                    _neg(F.col("__best")), F.col("topicId"), _neg(F.col("agreeability")),
                    F.col("argumentId"))
    tc = top_comments(top, edges, comments, n_comments).filter(F.col("commentId").isNotNull())
    cbest = tc.groupBy("dataset", "topicId", "argumentId").agg(F.max("agrees").alias("__best"))
    tc = tc.join(cbest, ["dataset", "topicId", "argumentId"])
    cbody = F.concat(F.col("commentText"), F.lit(" _("),
                     (F.col("agrees") + F.col("disagrees")).cast("string"), F.lit(" votes, "),
                     A.pct(F.col("agreeability")), F.lit("% agree_)"))
    com_rows = _row(tc, 3, A.comment(F.concat(F.lit("Comment "), F.col("commentId").cast("string")),
                                     cbody, supports_argument=F.col("argumentTitle")),
                    _neg(F.col("__best")), F.col("topicId"), F.col("argumentId"),
                    _neg(F.col("agrees")), F.col("commentId"))
    out = _frame(summary) + [_topics(ats, topics), arg_rows, com_rows]
    res = out[0]
    for d in out[1:]:
        res = res.unionByName(d)
    return res


def all_map(summary: DataFrame, topics: DataFrame, arguments: DataFrame, edges: DataFrame,
            comments: DataFrame, ats: DataFrame) -> DataFrame:
    """K3: heading, topics, every scored argument (best first), every
    distinct supporting comment (by id), then each argument's support links."""
    body = F.concat(F.col("argumentContent"), F.lit(" ("),
                    (F.col("agrees") + F.col("disagrees")).cast("string"),
                    F.lit(" voters approximated, "), A.pct(F.col("agreeability")),
                    F.lit("% tend to agree)"))
    arg_rows = _row(ats, 2, A.argument(F.col("argumentTitle"), body, F.col("topicHeading")),
                    _neg(F.col("agreeability")), F.col("topicId"), F.col("argumentId"))
    sup = supporting(edges)
    ids = sup.select("dataset", "commentId").distinct()
    c = ids.join(comments.select("dataset", "commentId", "commentText", "agrees", "disagrees",
                                 "agreeability"), ["dataset", "commentId"], "left")
    cbody = F.concat(F.col("commentText"), F.lit(" ("),
                     (F.col("agrees") + F.col("disagrees")).cast("string"), F.lit(" votes, "),
                     A.pct(F.col("agreeability")), F.lit("% agree)"))
    com_rows = _row(c, 3, A.comment(F.concat(F.lit("Comment "), F.col("commentId").cast("string")),
                                    cbody), F.col("commentId"))
    links = sup.select("dataset", "topicId", "argumentId", "commentId").join(
        arguments.select("dataset", "topicId", "argumentId", "argumentTitle"),
        ["dataset", "topicId", "argumentId"], "left")
    heads = links.select("dataset", "topicId", "argumentId", "argumentTitle").distinct()
    head_rows = _row(heads, 4, F.concat(F.lit("\n<"), F.coalesce(F.col("argumentTitle"), F.lit("None")),
                                        F.lit(">\n")),
                     F.col("topicId"), F.col("argumentId"), F.lit(-1))
    link_rows = _row(links, 4, A.supported_by(F.concat(F.lit("Comment "),
                                                       F.col("commentId").cast("string"))),
                     F.col("topicId"), F.col("argumentId"), F.col("commentId"))
    out = _frame(summary) + [_topics(ats, topics), arg_rows, com_rows, head_rows, link_rows]
    res = out[0]
    for d in out[1:]:
        res = res.unionByName(d)
    return res


def fenced(lines: DataFrame, as_map: bool = True) -> DataFrame:
    """A map's rows with those of the Markdown block around them, one before and one after each dataset's."""
    opening, closing = A.fence(as_map)
    names = lines.select("dataset").distinct()
    return lines.unionByName(_row(names, -2, F.lit(opening))).unionByName(_row(names, 100, F.lit(closing)))


def write_maps(lines: DataFrame, path: str, partitions: int | None = None) -> None:
    """Write each dataset's map as text under ``path/dataset=<name>/``.

    A range-partitioned sort on (dataset, keys) orders the rows across part
    files; reading a dataset's part files in name order gives its document.
    Every text row ends with a newline; the writer's line separator puts it
    back after it is cut here."""
    df = lines.repartitionByRange(*(["dataset"] + KEYS)) if partitions is None else \
        lines.repartitionByRange(partitions, *(["dataset"] + KEYS))
    body = F.expr("substring(text, 1, length(text) - 1)")
    (df.sortWithinPartitions("dataset", *KEYS)
     .select("dataset", F.when(F.col("text").endswith("\n"), body).otherwise(F.col("text")).alias("text"))
     .write.mode("overwrite").option("lineSep", "\n").partitionBy("dataset").text(path))


def comment_agreeability(comments: DataFrame) -> DataFrame:
    """Comments with the unguarded ratio (I2) used by the top map."""
    return comments.withColumn("agreeability", agreeability())
