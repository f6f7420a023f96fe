"""Titles ask the term model only for the terms of the statements that become arguments (F13); pairs of a topic are spread."""

import pytest

from polyvox.operators import arguments as AR
from polyvox.operators import text as T


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_weights_of_some_documents_are_those_of_the_whole_model(spark):
    docs = spark.createDataFrame([("a", 1, 0, "Ab cd ab cd"), ("a", 2, 1, "ab x"), ("a", 3, 1, "cd ef"), ("a", None, 1, "ef"), ("a", 4, -1, "ab gh"), ("a", 5, 0, None),
                                  ("b", 1, 2, "ab ab ef")], "dataset string, commentId bigint, topicId int, commentText string")
    dterms = T.doc_terms(docs)
    _, idf = T.ctfidf(T.topic_term_counts(dterms))
    of = lambda df: sorted(tuple(r[c] for c in ("dataset", "commentId", "term", "dweight")) for r in df.collect())
    some = spark.createDataFrame([("a", 1), ("a", 4), ("a", 4), ("b", 1), ("a", 99), ("a", None)], "dataset string, commentId bigint")
    got = T.doc_weights_of(dterms, some)
    want = of(T.doc_weights(dterms, idf).join(some, ["dataset", "commentId"], "left_semi"))
    assert [r[:3] for r in of(got)] == [r[:3] for r in want] and len(want) == 9
    assert [r[3] for r in of(got)] == pytest.approx([r[3] for r in want])
    # other documents' terms are dropped before they are dealt out by term
    assert "LeftSemi" in plan(got).split("RepartitionByExpression", 1)[1]


def test_titles_are_the_best_terms_of_the_statement(spark):
    rows = [("a", i, i % 2, f"word{i} road river road. More of word{i}", i / 10, i, 1) for i in range(12)]
    docs = spark.createDataFrame(rows, "dataset string, commentId bigint, topicId int, commentText string, agreeability double, agrees bigint, moderated int")
    dterms = T.doc_terms(docs)
    _, idf = T.ctfidf(T.topic_term_counts(dterms))
    sources = AR.argument_sources(docs)
    assert {r["commentId"] for r in sources.collect()} == {11, 9, 7, 5, 10, 8, 6, 4}  # ceil(2 ln 6) = 4 of each topic
    made = lambda w: sorted(map(tuple, AR.generate_arguments(docs, w).collect()))
    assert made(T.doc_weights_of(dterms, sources)) == made(T.doc_weights(dterms, idf)) and len(made(T.doc_weights(dterms, idf))) == 8


def test_statements_of_one_topic_are_spread(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    was = {k: spark.conf.get(k) for k in conf}
    s = spark.range(9001).selectExpr("'a' AS dataset", "IF(id < 9000, 1, 2) AS topicId", "id AS commentId", "concat('text ', id) AS commentText")
    s = s.union(spark.sql("SELECT 'a', NULL, 9001L, 'none'"))
    a = spark.createDataFrame([("a", 1, 0, "t", "one"), ("a", 1, 1, "u", "two"), ("a", 2, 0, "v", "three"), ("a", None, 0, "w", "four")],
                              "dataset string, topicId int, argumentId bigint, argumentTitle string, argumentContent string")
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        got = AR.pair_prompts(s, a).selectExpr("topicId", "argumentId", "commentId", "prompt", "spark_partition_id() AS part").collect()
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)
    assert sorted(tuple(r)[:3] for r in got) == sorted([(1, k, i) for i in range(9000) for k in (0, 1)] + [(2, 0, 9000)])
    assert all(f"\nCOMMENT: text {r['commentId']}\n" in r["prompt"] for r in got)
    assert len({r["part"] for r in got if r["topicId"] == 1}) > 1
