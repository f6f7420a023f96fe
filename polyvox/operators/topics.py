"""Topic tables.

Topic keyword lists come from c-TF-IDF (``polyvox.operators.text``); this
module shapes them into the reference's topic table and applies the
keyword diversification and labelling rules.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from polyvox.operators.skew import few
from polyvox.sources.store import staged

MMR_SCHEMA = "dataset string, topicId int, rank int, term string"


def _mmr(pdf: pd.DataFrame, k: int = 10, diversity: float = 0.3) -> pd.DataFrame:
    """Greedy maximal marginal relevance over one topic's candidates.

    relevance(w) = weight(t, w) / max weight in t; redundancy(w, v) = cosine
    of the two terms' weight profiles over the dataset's topics."""
    pdf = pdf.sort_values(["weight", "term"], ascending=[False, True]).reset_index(drop=True)
    rel = pdf["weight"].to_numpy() / max(pdf["weight"].max(), 1e-300)
    topics = sorted({t for prof in pdf["profile"] for t in dict(prof)})
    pos = {t: i for i, t in enumerate(topics)}
    P = np.zeros((len(pdf), len(topics)))
    for i, prof in enumerate(pdf["profile"]):
        for t, w in dict(prof).items():
            P[i, pos[t]] = w
    P /= np.maximum(np.linalg.norm(P, axis=1, keepdims=True), 1e-300)
    S = P @ P.T
    chosen = [0]
    while len(chosen) < min(k, len(pdf)):
        rest = [i for i in range(len(pdf)) if i not in chosen]
        score = [(1 - diversity) * rel[i] - diversity * S[i, chosen].max() for i in rest]
        chosen.append(rest[int(np.argmax(score))])
    return pd.DataFrame({"dataset": pdf["dataset"].iloc[0], "topicId": pdf["topicId"].iloc[0],
                         "rank": range(1, len(chosen) + 1),
                         "term": [pdf["term"].iloc[i] for i in chosen]})


def mmr_keywords(weights: DataFrame, candidates: int = 30, k: int = 10,
                 diversity: float = 0.3) -> DataFrame:
    """H9: diversify each topic's keywords by MMR (diversity 0.3).

    Each topic's group holds its ``candidates`` best terms (bounded), each
    with its weight profile over the dataset's topics (one
    entry per topic), so the pandas step is small whatever the data size."""
    w = Window.partitionBy("dataset", "topicId").orderBy(F.desc("weight"), "term")
    cand = staged(weights.withColumn("__r", F.row_number().over(w)).filter(F.col("__r") <= candidates)
                  .drop("__r"), "candidates")
    # at most topics x candidates terms; unless they are very many the weights are read past them, not moved
    asked = few(staged(cand.select("dataset", "term").distinct(), "terms-asked"))
    prof = (weights.join(asked, ["dataset", "term"])
            .groupBy("dataset", "term")
            .agg(F.map_from_entries(F.collect_list(F.struct("topicId", "weight"))).alias("profile")))
    g = cand.join(prof, ["dataset", "term"])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.assign(profile=[list(dict(p).items()) if not isinstance(p, list) else p
                                  for p in pdf["profile"]])
        return _mmr(pdf, k, diversity)
    return g.groupBy("dataset", "topicId").applyInPandas(run, MMR_SCHEMA)


def headings(keywords: DataFrame, taboo: DataFrame | None = None,
             n_heading: int = 2, n_title: int = 5, topics: DataFrame | None = None) -> DataFrame:
    """J6 default + C16: Heading = first ``n_heading`` keywords, Title = first
    ``n_title`` (comma separated), skipping keywords with a word of the
    dataset title (``taboo``: dataset, word); topic -1 -> "Outliers". With
    ``topics`` (dataset, topicId) every topic gets a row, also the outliers,
    which have no keywords; a topic whose keywords are all taboo is "Topic n"."""
    kw = keywords
    if taboo is not None:
        bad = (kw.select("dataset", "topicId", "term", F.explode(F.split("term", " ")).alias("word"))
               .join(taboo, ["dataset", "word"], "left_semi")
               .select("dataset", "topicId", "term").distinct())
        kw = kw.join(bad, ["dataset", "topicId", "term"], "left_anti")
    w = Window.partitionBy("dataset", "topicId").orderBy("rank")
    kw = kw.withColumn("__r", F.row_number().over(w)).filter(F.col("__r") <= max(n_heading, n_title))
    g = kw.groupBy("dataset", "topicId").agg(
        F.sort_array(F.collect_list(F.struct("__r", "term"))).alias("__k"))
    if topics is not None:
        g = topics.select("dataset", "topicId").distinct().join(g, ["dataset", "topicId"], "left")
    out = F.col("topicId") == -1
    bare = F.concat(F.lit("Topic "), F.col("topicId").cast("string"))
    return g.select(
        "dataset", F.col("topicId").alias("Topic"),
        F.when(out, F.lit("Outliers")).otherwise(
            F.coalesce(F.array_join(F.slice(F.col("__k.term"), 1, n_heading), " "), bare)).alias("Heading"),
        F.when(out, F.lit("Outliers")).otherwise(
            F.coalesce(F.array_join(F.slice(F.col("__k.term"), 1, n_title), ", "), bare)).alias("Title"))


def topic_info(sizes: DataFrame, keywords: DataFrame, rep_docs: DataFrame,
               comments: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """H10 (+ H21): Topic, Count, Representation[], Representative_Docs[]
    (+ Title, Heading). Lists are bounded (top-k keywords, top-3 docs)."""
    rep = (rep_docs.join(comments.select("dataset", "commentId", "commentText"), ["dataset", "commentId"])
           .groupBy("dataset", "topicId")
           .agg(F.sort_array(F.collect_list(F.struct("rank", "commentText"))).alias("__d"))
           .select("dataset", "topicId", F.col("__d.commentText").alias("Representative_Docs")))
    kw = (keywords.groupBy("dataset", "topicId")
          .agg(F.sort_array(F.collect_list(F.struct("rank", "term"))).alias("__k"))
          .select("dataset", "topicId", F.col("__k.term").alias("Representation")))
    t = (sizes.select("dataset", "topicId", F.col("size").alias("Count"))
         .join(kw, ["dataset", "topicId"], "left").join(rep, ["dataset", "topicId"], "left")
         .withColumnRenamed("topicId", "Topic"))
    if labels is not None:
        t = t.join(labels, ["dataset", "Topic"], "left")
    return t


def replace_columns(df: DataFrame, other: DataFrame, on: list[str], cols: list[str]) -> DataFrame:
    """D2 / H20 (join in place): drop ``cols`` from ``df`` and take them from
    ``other`` by a left join on ``on`` (rows without a match get NULL)."""
    return df.drop(*cols).join(other.select(*on, *cols), on, "left")


def ancestors(tree: DataFrame, levels: int = 10) -> DataFrame:
    """(dataset, topicId, ancestors array<int>) from a merge tree.

    Level l of ``levels`` holds the first ceil(l / levels) share of the
    dataset's merges; entry l is the node that the topic is part of by then
    (the topic itself, if none), so the last entry is the root."""
    own = Window.partitionBy("dataset")  # one row per merge; the tree itself is built per dataset
    at = (tree.withColumn("__rank", F.col("Parent_ID") - F.min("Parent_ID").over(own) + 1).withColumn("__n", F.count("*").over(own))
          .select("dataset", "Parent_ID", "__rank", "__n", F.explode("Topics").alias("topicId")))
    path = at.groupBy("dataset", "topicId").agg(F.max("__n").alias("__n"),
                                                F.collect_list(F.struct("Parent_ID", "__rank")).alias("__path"))

    def node(level):
        done = F.filter("__path", lambda m: m["__rank"] * levels < F.col("__n") * level + levels)
        return F.coalesce(F.array_max(F.transform(done, lambda m: m["Parent_ID"])), F.col("topicId")).cast("int")
    return path.select("dataset", F.col("topicId").cast("int").alias("topicId"),
                       F.transform(F.sequence(F.lit(1), F.lit(levels)), node).alias("ancestors"))


def document_map(assign: DataFrame, coords: DataFrame, tree: DataFrame, labels: DataFrame, levels: int = 10) -> DataFrame:
    """One row per document with a vector: its coordinates, topic and Heading, and the
    tree node that it belongs to at each of ``levels`` cuts. Topics outside the tree (outliers,
    the only topic of a dataset) are their own node throughout."""
    up = labels.select("dataset", F.col("Topic").alias("topicId"), "Heading").join(
        ancestors(tree, levels), ["dataset", "topicId"], "full")
    out = coords.join(assign.select("dataset", "commentId", "topicId"), ["dataset", "commentId"]).join(up, ["dataset", "topicId"], "left")
    return out.select(*coords.columns, "topicId", F.when(F.col("topicId") == -1, F.lit("Outliers")).otherwise(F.col("Heading")).alias("Heading"),
                      F.coalesce("ancestors", F.array_repeat("topicId", levels)).alias("ancestors"))
