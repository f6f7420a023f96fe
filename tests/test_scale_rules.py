"""Cases that earlier cuts and size-dependent rules got wrong."""

import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from polyvox.operators import cluster as K
from polyvox.operators import embed as EM
from polyvox.operators import moderation as M
from polyvox.operators import scoring as S
from polyvox.operators import text as T
from polyvox.operators import topics as TP
from polyvox.streaming import votes as SV


def vectors(spark, rows):
    return spark.createDataFrame(rows, "dataset string, commentId bigint, embedding array<float>")


def test_zero_vectors_are_outliers(spark):
    docs = spark.createDataFrame([("d", i, t) for i, t in enumerate(
        ["fix the road", "fix the bridge", "road and bridge", "more trees please", "trees in the park", "...", "?!", "park benches"])],
        "dataset string, commentId bigint, commentText string")
    emb = EM.hash_embeddings(docs, dims=64)
    got = {r["commentId"]: r["topicId"] for r in K.kmeans_topics(emb.select("dataset", "commentId", "embedding")).collect()}
    assert len(got) == 8 and got[5] == got[6] == -1
    assert K.silhouette(emb.withColumn("topicId", F.lit(0))).count() == 1


@pytest.mark.parametrize("broadcast", [True, False])
def test_all_clusters_are_kept(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(K, "BROADCAST_NUMBERS", 0)
    used, nearest = [], K._nearest
    monkeypatch.setattr(K, "_nearest", lambda pts, cents: used.append(cents.count()) or nearest(pts, cents))
    rng = np.random.default_rng(0)
    rows = [(d, i, [float(x) for x in rng.normal(size=12)]) for d, n in (("a", 400), ("b", 249)) for i in range(n)]
    assert K.kmeans_topics(vectors(spark, rows), k=80, max_iter=2).count() == 649 and set(used) == {160}
    used.clear()
    assert K.kmeans_topics(vectors(spark, rows[400:]), max_iter=1).count() == 249 and set(used) == {62}


def test_linked_microclusters_are_one_topic(spark):
    # an arc: round clusters cut it, linked ones don't
    rows = [("d", i, [float(np.cos(i / 100)), float(np.sin(i / 100)), 0.0]) for i in range(200)]
    rows += [("d", 200 + i, [0.0, 0.0, 1.0 + i / 1000]) for i in range(50)]
    topics = K.kmeans_topics(vectors(spark, rows), k=12, link_distance=0.1)
    assert [r["n"] for r in topics.groupBy("topicId").agg(F.count("*").alias("n")).orderBy("topicId").collect()] == [200, 50]


def test_kmeans_says_when_it_stops_early(spark):
    rng = np.random.default_rng(4)
    rows = [("d", i, [float(x) for x in rng.normal(size=3)]) for i in range(400)]
    with pytest.warns(UserWarning, match="still moved"):
        K.kmeans_topics(vectors(spark, rows), max_iter=1)


def test_components_on_a_long_path_or_error(spark):
    n = 12
    edges = spark.createDataFrame([("d", i, i + 1) for i in range(n)], "dataset string, src bigint, dst bigint")
    nodes = spark.createDataFrame([("d", i) for i in range(n + 1)], "dataset string, node bigint")
    assert {r["label"] for r in K.components(edges, nodes).collect()} == {0}
    with pytest.raises(RuntimeError):
        K.components(edges, nodes, max_iter=3)


def test_vectors_do_not_depend_on_other_datasets(spark):
    rows = [("a", 1, "fix the road"), ("a", 2, "plant a tree"), ("b", 1, "the road the road"), ("b", 2, "more trees")]
    docs = spark.createDataFrame(rows, "dataset string, commentId bigint, commentText string")
    both = {r["commentId"]: r["embedding"] for r in EM.hash_embeddings(docs, dims=32).filter("dataset = 'a'").collect()}
    alone = {r["commentId"]: r["embedding"] for r in EM.hash_embeddings(docs.filter("dataset = 'a'"), dims=32).collect()}
    assert both == alone and abs(sum(x * x for x in both[1]) - 1) < 1e-6


def test_small_datasets_keep_their_terms(spark):
    docs = spark.createDataFrame([("d", 1, 0, "new road here"), ("d", 2, 0, "new bridge")],
                                 "dataset string, commentId bigint, topicId int, commentText string")
    terms = {(r["commentId"], r["term"], r["n"]) for r in T.doc_terms(docs).collect()}
    assert terms == {(1, "new", 1), (1, "road", 1), (1, "here", 1), (1, "new road", 1), (1, "road here", 1),
                     (2, "new", 1), (2, "bridge", 1), (2, "new bridge", 1)}
    stop = spark.createDataFrame([("d", "road")], "dataset string, word string")
    assert {r["term"] for r in T.doc_terms(docs, stop).filter("commentId = 1").collect()} == {"new", "here", "new here"}
    assert T.doc_terms(docs, max_df=0.6).filter("term = 'new'").count() == 0


def test_terms_of_odd_documents(spark, monkeypatch):
    """Null, empty, one-word, repeating and stop-only texts; the two ways to the stop words agree."""
    texts = {1: None, 2: "", 3: "alone", 4: "go go go go", 5: "the of the", 6: "the road of the road", 7: "a b c"}
    docs = spark.createDataFrame([(d, i, 0, t) for d in ("d", "e") for i, t in texts.items()],
                                 "dataset string, commentId bigint, topicId int, commentText string")
    stop = spark.createDataFrame([("d", "the"), ("d", "of"), ("d", "of")], "dataset string, word string")

    def terms(docs):
        return sorted((r["dataset"], r["commentId"], r["term"], r["n"], r["total"]) for r in T.doc_terms(docs, stop).collect())
    got = terms(docs)
    assert [x for x in got if x[0] == "d"] == [
        ("d", 3, "alone", 1, 1), ("d", 4, "go", 4, 7), ("d", 4, "go go", 3, 7), ("d", 6, "road", 2, 3), ("d", 6, "road road", 1, 3)]
    assert ("e", 5, "the", 2, 5) in got and ("e", 5, "of the", 1, 5) in got and ("e", 6, "the road", 2, 9) in got
    monkeypatch.setattr(T, "BROADCAST_WORDS", 1)
    assert terms(docs) == got
    assert terms(docs.filter("false")) == []
    words = {(r["dataset"], r["commentId"]): r["words"] for r in T.kept_words(docs, stop).collect()}
    assert words["d", 6] == ["road", "road"] and ("d", 5) not in words and words["e", 5] == ["the", "of", "the"]


def test_outliers_and_taboo_topics_have_headings(spark):
    kw = spark.createDataFrame([("d", 0, "road", 1), ("d", 0, "bridge", 2), ("d", 1, "town", 1)],
                               "dataset string, topicId int, term string, rank int")
    topics = spark.createDataFrame([("d", -1), ("d", 0), ("d", 1)], "dataset string, topicId int")
    taboo = spark.createDataFrame([("d", "town")], "dataset string, word string")
    got = {r["Topic"]: (r["Heading"], r["Title"]) for r in TP.headings(kw, taboo, topics=topics).collect()}
    assert got == {-1: ("Outliers", "Outliers"), 0: ("road bridge", "road, bridge"), 1: ("Topic 1", "Topic 1")}


def test_two_step_labels(spark):
    text = ["hi", "We need a new bridge over the river soon", ". ".join(["One more idea here"] * 40) + ".",
            ". ".join(["One more idea here"] * 70) + "."]
    docs = spark.createDataFrame([("d", i, t, 1) for i, t in enumerate(text)], "dataset string, commentId bigint, commentText string, moderated int")
    got = {(r["config"], r["commentId"]): (r["classification"], r["languageModelModerated"], r["moderated"])
           for r in M.classify(M.text_features(docs), M.config_table(spark)).collect()}
    for c in (1, 3):
        assert got[c, 0] == ("SPAM", -1, 1) and got[c, 1] == ("ACCEPT", 1, 1)
    assert got[1, 2][0] != "REJECT" and got[9, 0][0] == "REJECT" and got[5, 0][0] == "SPAM"
    assert not {v[0] for (c, _), v in got.items() if c <= 4} & {"REJECT"}


@pytest.mark.parametrize("files", [1, 4, 8])
def test_stream_windows_lose_no_votes(spark, tmp, files):
    log = (spark.range(20_000).select(F.lit("d").alias("dataset"), (F.col("id") % 7).alias("commentId"),
                                      F.when(F.col("id") % 3 == 0, -1).otherwise(1).alias("vote"),
                                      F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 60).alias("ts")))
    path = SV.stage_log(log, f"{tmp}/log", files=files)
    stream = SV.file_stream(spark, path, log.schema, files)
    got = SV.run_available(SV.window_counts(stream, watermark="1 hour"), f"test-{uuid.uuid4().hex}", "append")
    last = log.agg(F.max("ts").alias("m")).first()["m"]
    want = SV.window_counts(log).filter(F.col("window_end") <= F.lit(last).cast("timestamp_ntz") - F.expr("INTERVAL 1 HOUR"))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0 and want.count() > 0


def test_refute_sample_has_its_first_reason(spark):
    edges = spark.createDataFrame(
        [("d", 0, 1, 5, "REFUTE", ["second"]), ("d", 0, 0, 5, "REFUTE", ["first", "more"]), ("d", 1, 0, 7, "REFUTE", []),
         ("d", 2, 0, 8, "SUPPORT", ["no"])],
        "dataset string, topicId int, argumentId bigint, commentId bigint, relationship string, reasoning array<string>")
    args = spark.createDataFrame([("d", 0, 0, "a"), ("d", 0, 1, "b"), ("d", 1, 0, "c")],
                                 "dataset string, topicId int, argumentId bigint, argumentTitle string")
    comments = spark.createDataFrame([("d", 5, "x", 1, 2), ("d", 7, "y", 0, 0)],
                                     "dataset string, commentId bigint, commentText string, agrees int, disagrees int")
    topics = spark.createDataFrame([("d", 0, "T0"), ("d", 1, "T1")], "dataset string, Topic int, Title string")
    got = {r["topicId"]: (r["argumentTitle"], r["reasoning"]) for r in S.refute_samples(edges, args, comments, topics).collect()}
    assert got == {0: ("a", "first"), 1: ("c", None)}
