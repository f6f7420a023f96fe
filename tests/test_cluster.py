"""Embedding-space operators on synthetic blobs and on the fixture."""

import numpy as np
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from polyvox.operators import cluster as K
from polyvox.operators import hierarchy as HI
from polyvox.operators import topics as TP
from polyvox.sources.adapters import Fixture

from polyvox_testdata import SF_SMALL


def _blobs(spark, n_per=60, k=3, d=8, seed=1):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(k, d)) * 5
    rows = []
    for c in range(k):
        for i in range(n_per):
            rows.append(("b", c * n_per + i, [float(x) for x in centers[c] + rng.normal(size=d) * 0.3], c))
    return spark.createDataFrame(rows, "dataset string, commentId bigint, embedding array<float>, label int")


def test_kmeans_recovers_blobs(spark):
    df = _blobs(spark)
    out = K.kmeans_topics(df.select("dataset", "commentId", "embedding"), k=3)
    j = out.join(df, ["dataset", "commentId"])
    # every true blob maps to exactly one found topic
    per = j.groupBy("label").agg(F.count_distinct("topicId").alias("n")).collect()
    assert all(r.n == 1 for r in per)
    assert j.select("topicId").distinct().count() == 3


def test_silhouette_matches_mllib(spark):
    a = Fixture(spark, SF_SMALL).assignment.filter(F.col("embedding").isNotNull())
    ours = K.silhouette(a).select("overall").first()[0]
    ev = ClusteringEvaluator(featuresCol="f", predictionCol="p", metricName="silhouette",
                             distanceMeasure="cosine")
    ml = ev.evaluate(a.select(array_to_vector("embedding").alias("f"),
                              F.col("topicId").cast("double").alias("p")))
    assert abs(ours - ml) < 1e-6


def test_components(spark):
    edges = spark.createDataFrame([("d", 1, 2), ("d", 2, 3), ("d", 5, 6)],
                                  "dataset string, src bigint, dst bigint")
    nodes = spark.createDataFrame([("d", i) for i in range(1, 8)], "dataset string, node bigint")
    got = {r.node: r.label for r in K.components(edges, nodes).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 5, 6: 5, 7: 7}


def test_hierarchy_is_monotone_tree(spark):
    from polyvox.plans.q_text import model
    _, _, weights, _ = model(spark, SF_SMALL)
    h = HI.hierarchy(weights).orderBy("Parent_ID").collect()
    n_topics = weights.select("topicId").distinct().count()
    assert len(h) == n_topics - 1
    d = [r.Distance for r in h]
    assert d == sorted(d)
    assert len(h[-1].Topics) == n_topics


def test_reassignment_leaves_no_outlier_with_vector(spark):
    a = Fixture(spark, SF_SMALL).assignment
    out = K.reassign_by_embedding(a, K.centroids(a))
    assert out.filter((F.col("topicId") == -1) & F.col("embedding").isNotNull()).count() == 0
    moved = out.join(a.select("dataset", "commentId", F.col("topicId").alias("t0")),
                     ["dataset", "commentId"])
    assert moved.filter((F.col("t0") >= 0) & (F.col("t0") != F.col("topicId"))).count() == 0


def test_silhouette_of_equal_vectors_is_zero(spark):
    df = spark.createDataFrame([("e", i, [1.0, 0.0], i % 2) for i in range(6)],
                               "dataset string, commentId bigint, embedding array<double>, topicId int")
    assert {r.silhouette for r in K.silhouette(df).collect()} == {0.0}


def test_sweep_has_a_row_per_setting(spark):
    df = _blobs(spark).select("dataset", "commentId", "embedding")
    got = {r.setting: r for r in K.sweep(df, [{"k": 3}, {"k": 3, "dims": 2}, {"k": 1}]).collect()}
    assert sorted(got) == [0, 1, 2] and got[1].params == "dims=2, k=3"
    assert (got[0].n_topics, got[0].n_outliers, got[0].n_comments) == (3, 0, 180) and got[0].silhouette > 0.9
    assert got[2].n_topics == 1 and got[2].silhouette is None


def test_document_map_follows_the_tree(spark):
    tree = spark.createDataFrame([("d", 4, [0, 1], 0.1), ("d", 5, [2, 3], 0.2), ("d", 6, [0, 1, 2, 3], 0.9)],
                                 "dataset string, Parent_ID int, Topics array<int>, Distance double")
    up = {r.topicId: r.ancestors for r in TP.ancestors(tree, levels=3).collect()}
    assert up == {0: [4, 4, 6], 1: [4, 4, 6], 2: [2, 5, 6], 3: [3, 5, 6]}
    assert [r.ancestors for r in TP.ancestors(tree, levels=1).collect()] == [[6]] * 4
    docs = spark.createDataFrame([("d", 10, 2), ("d", 11, -1), ("x", 12, 0)], "dataset string, commentId bigint, topicId int")
    at = docs.selectExpr("dataset", "commentId", "0.5 as pc1", "0.25 as pc2")
    labels = spark.createDataFrame([("d", 2, "two"), ("x", 0, "alone")], "dataset string, Topic int, Heading string")
    got = {r.commentId: (r.Heading, r.ancestors) for r in TP.document_map(docs, at, tree, labels, levels=3).collect()}
    assert got == {10: ("two", [2, 5, 6]), 11: ("Outliers", [-1] * 3), 12: ("alone", [0] * 3)}


def test_rounds_move_sums_and_are_shared(spark, monkeypatch):
    """a round is a job whose tasks return sums; settings that differ in distances share their rounds."""
    rng = np.random.default_rng(7)
    rows = [(d, i, [float(x) for x in rng.normal(size=6)]) for d, n in (("a", 90), ("b", 70)) for i in range(n)] + [("a", 500, None), ("a", 501, [0.0] * 6)]
    df = spark.createDataFrame(rows, "dataset string, commentId bigint, embedding array<double>")
    means, staged, rounds = K._means, K._ckpt, []
    written = []
    monkeypatch.setattr(K, "_means", lambda pts, arrays: rounds.append(1) or means(pts, arrays))
    monkeypatch.setattr(K, "_ckpt", lambda x: written.append(1) or staged(x))
    by_sums = {tuple(r) for r in K.kmeans_topics(df, k=6).collect()}
    assert len(rounds) > 2 and len(written) == 4
    one = len(rounds)
    K.sweep(df, [{"k": 6}, {"k": 6, "outlier_distance": 0.5}]).collect()
    assert len(rounds) == 2 * one
    monkeypatch.setattr(K, "BROADCAST_NUMBERS", 0)
    assert {tuple(r) for r in K.kmeans_topics(df, k=6).collect()} == by_sums and len(rounds) == 2 * one and len(by_sums) == 161  # null vectors are left out
