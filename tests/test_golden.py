"""Literal cases from FIXTURES.md (golden argument-support case and extras)."""

import math

from pyspark.sql import functions as F

from polyvox.functions import exprs as X
from polyvox.operators import moderation as M
from polyvox.operators import scoring as S
from polyvox.operators.votes import comment_tally, latest_vote


def _edges(spark, rows):
    return spark.createDataFrame(
        [("d", c, 0, a, r) for c, a, r in rows],
        "dataset string, commentId bigint, topicId int, argumentId bigint, relationship string")


def _votes(spark, rows):
    return spark.createDataFrame([("d", c, v, x) for c, v, x in rows],
                                 "dataset string, commentId bigint, voterId bigint, vote int")


def test_golden_argument_support(spark):
    votes = _votes(spark, [(1, 1, 1), (1, 2, -1), (1, 3, 1), (1, 4, 1),
                           (2, 3, 1), (2, 4, 1), (2, 5, -1)])
    edges = _edges(spark, [(1, 0, "SUPPORT"), (2, 0, "SUPPORT")])
    tally = {r.commentId: (r.agrees, r.disagrees) for r in comment_tally(votes).collect()}
    assert tally == {1: (3, 1), 2: (2, 1)}
    r = S.argument_support(S.voter_net_vote(edges, votes)).collect()
    assert len(r) == 1
    r = r[0]
    assert (r.agrees, r.disagrees, r.support) == (3, 2, 1)
    assert math.isclose(r.agreeability, 0.6)


def test_golden_with_salting_forced(spark):
    spark.conf.set("polyvox.skew.hotRows", "1")
    try:
        votes = _votes(spark, [(1, 1, 1), (1, 2, -1), (1, 3, 1), (1, 4, 1),
                               (2, 3, 1), (2, 4, 1), (2, 5, -1)])
        edges = _edges(spark, [(1, 0, "SUPPORT"), (2, 0, "SUPPORT")])
        r = S.argument_support(S.voter_net_vote(edges, votes)).collect()[0]
        assert (r.agrees, r.disagrees, r.support) == (3, 2, 1)
    finally:
        spark.conf.unset("polyvox.skew.hotRows")


def _log(spark, rows):
    return spark.createDataFrame([("d", c, v, x, t) for c, v, x, t in rows],
                                 "dataset string, commentId bigint, voterId bigint, vote int, ts bigint")


def test_revote_takes_latest(spark):
    r = latest_vote(_log(spark, [(1, 1, -1, 1), (1, 1, 1, 2)]), ["ts"]).collect()
    assert [(x.vote, x.timestamp) for x in r] == [(1, 2)]


def test_pass_after_vote_keeps_vote(spark):
    r = latest_vote(_log(spark, [(1, 1, 1, 1), (1, 1, 0, 2)]), ["ts"]).collect()
    assert [x.vote for x in r] == [1]
    r = latest_vote(_log(spark, [(1, 1, 1, 1), (1, 1, 0, 2)]), ["ts"], pass_cancels=True).collect()
    assert r == []


def test_neutral_voter_and_all_neutral_argument(spark):
    votes = _votes(spark, [(1, 7, 1), (2, 7, -1), (3, 8, 1), (4, 8, -1)])
    edges = _edges(spark, [(1, 0, "SUPPORT"), (2, 0, "SUPPORT"), (3, 1, "SUPPORT"),
                           (4, 1, "SUPPORT")])
    res = {r.argumentId: r for r in S.argument_support(S.voter_net_vote(edges, votes)).collect()}
    for a in (0, 1):
        assert (res[a].agrees, res[a].disagrees, res[a].support) == (0, 0, 0)
        assert res[a].agreeability is None
    ranked = S.ranked(S.argument_support(S.voter_net_vote(
        edges.unionByName(_edges(spark, [(5, 2, "SUPPORT")])),
        votes.unionByName(_votes(spark, [(5, 9, 1)]))))).collect()
    assert ranked[0].argumentId == 2 and ranked[-1].agreeability is None


def test_no_votes_agreeability_zero(spark):
    df = spark.createDataFrame([(0, 0), (3, 1)], "agrees bigint, disagrees bigint")
    got = [r.a for r in df.select(X.agreeability_guarded().alias("a")).collect()]
    assert got == [0.0, 0.75]


def test_argument_budget(spark):
    df = spark.createDataFrame([(1,), (2,), (13,)], "n bigint")
    got = [r.b for r in df.select(X.argument_budget("n").alias("b")).collect()]
    assert got == [0, math.ceil(2 * math.log(2)), math.ceil(2 * math.log(13))]


def test_metrics_literal_case(spark):
    truth = [-1, -1, 1, 1, 0]
    pred = [-1, 1, -1, 0, 1]
    df = spark.createDataFrame([("d", 1, i, p, t) for i, (t, p) in enumerate(zip(truth, pred))],
                               "dataset string, config int, commentId bigint, "
                               "languageModelModerated int, moderated int")
    m = M.metrics(df).collect()[0]
    assert (m.tp, m.fn, m.fp, m.tn) == (1, 1, 1, 0)
    assert math.isclose(m.unsure, 0.2)
    assert math.isclose(m.accuracy, 1 / 3)
    assert math.isclose(m.precision, 0.5) and math.isclose(m.recall, 0.5)
    assert math.isclose(m.f1, 0.5) and math.isclose(m.fpr, 1.0)
    assert m.dot == -1
    cells = M.confusion(df).agg(F.sum("count")).first()[0]
    assert cells == 5


def test_label_codes(spark):
    df = spark.createDataFrame([("ACCEPT",), ("UNSURE",), ("IRRELEVANT",), ("SPAM",)], "c string")
    assert [r.x for r in df.select(X.label_code("c").alias("x")).collect()] == [1, 0, -1, -1]


def test_stop_rules(spark):
    df = spark.createDataFrame([("a b. c\nd",)], "s string")
    r = df.select(X.first_line("s").alias("l"), X.first_phrase("s").alias("p")).first()
    assert (r.l, r.p) == ("a b. c", "a b")


def test_short_token_lists_make_no_bigrams(spark):
    df = spark.createDataFrame([([],), (["x"],), (["x", "y", "z"],)], "t array<string>")
    got = [r.b for r in df.select(X.bigrams("t").alias("b")).collect()]
    assert got == [[], [], ["x y", "y z"]]
