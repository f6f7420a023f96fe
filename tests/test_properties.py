"""Invariants (survey section 5): order independence, partition-count
independence, tallies bounded by voters, salted joins equal plain joins."""

from pyspark.sql import functions as F

from polyvox.operators import scoring as S
from polyvox.operators.skew import salted_join
from polyvox.operators.votes import latest_vote
from polyvox.sources.adapters import VOTE_ORDER, Fixture

from polyvox_testdata import SF_SMALL


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_latest_vote_ignores_row_order(spark):
    raw = Fixture(spark, SF_SMALL, stored=False).votes_raw
    a = latest_vote(raw, VOTE_ORDER)
    b = latest_vote(raw.orderBy(F.rand(7)).repartition(5), VOTE_ORDER)
    assert _rows(a) == _rows(b)


def test_same_result_with_1_and_200_partitions(spark):
    f = Fixture(spark, SF_SMALL, stored=False)
    q = lambda: S.score(f.topics, f.arguments, f.edges, f.votes)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        one = _rows(q())
        spark.conf.set("spark.sql.shuffle.partitions", "200")
        many = _rows(q())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert one == many


def test_agrees_plus_disagrees_at_most_voters(spark):
    f = Fixture(spark, SF_SMALL)
    per_voter = S.voter_net_vote(f.edges, f.votes)
    voters = per_voter.groupBy("dataset", "topicId", "argumentId").agg(
        F.count_distinct("voterId").alias("v"))
    sup = S.argument_support(per_voter).join(voters, ["dataset", "topicId", "argumentId"])
    assert sup.filter(F.col("agrees") + F.col("disagrees") > F.col("v")).count() == 0


def test_salted_join_equals_plain_join(spark):
    big = spark.range(0, 5000).select(F.lit("d").alias("dataset"),
                                      (F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    small = spark.range(0, 3).select(F.lit("d").alias("dataset"), F.col("id").alias("k"),
                                     (F.col("id") * 10).alias("w"))
    plain = big.join(small, ["dataset", "k"])
    salted = salted_join(big, small, ["dataset", "k"], spread_by=["v"], hot_rows=100, buckets=8)
    assert _rows(plain.select("dataset", "k", "v", "w")) == _rows(salted.select("dataset", "k", "v", "w"))
    left = salted_join(big, small.filter("k < 2"), ["dataset", "k"], spread_by=["v"], how="left",
                       hot_rows=100, buckets=8)
    assert left.count() == 5000


def test_stored_and_derived_fixture_agree(spark):
    stored = Fixture(spark, SF_SMALL)
    derived = Fixture(spark, SF_SMALL, stored=False)
    assert _rows(stored.arguments) == _rows(derived.arguments)
    assert _rows(stored.edges) == _rows(derived.edges)


def test_argument_prompts_hold_every_statement(spark):
    from polyvox.operators import arguments
    rows = [("d", 1, i, f"text {i}", 200 - i, i, 1.0 - i / 200) for i in range(120)] + [("d", 2, 500, "alone", 0, 0, 0.5)]
    agreeable = spark.createDataFrame(rows, "dataset string, topicId int, commentId long, commentText string, agrees long, disagrees long, agreeability double")
    summary = spark.createDataFrame([("d", "topic", "T")], "dataset string, key string, value string")
    got = arguments.argument_prompts(agreeable, summary).orderBy("topicId", "part").collect()
    assert [(r.topicId, r.part) for r in got] == [(1, 0), (1, 1), (1, 2), (2, 0)]
    lines = [x for r in got[:3] for x in r.prompt.split("\n\n", 1)[1].split("\n")]
    assert [int(x.split(".")[0]) for x in lines] == list(range(120))
