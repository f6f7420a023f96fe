"""Work on pairs is spread and its rows stay few: voter pairs are not shuffled."""

import itertools
import random

from pyspark.sql import functions as F

from polyvox.operators.votes import opinion_tiles, voter_agreement


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_voter_pairs_are_made_whole_in_their_task(spark):
    rng = random.Random(6)
    votes = {(v, c): rng.choice([1, -1]) for v in range(90) for c in rng.sample(range(6), 3)}
    rows = [("a", c, v, x) for (v, c), x in votes.items()] + [("a", 1, None, 1), ("a", None, 5, 1), ("a", None, 6, 1), ("b", 1, 1, 1)]
    tiles = opinion_tiles(spark.createDataFrame(rows, "dataset string, commentId bigint, voterId bigint, vote int"), tile=16)
    want = {}
    for v, w in itertools.combinations(range(90), 2):
        both = [c for c in range(6) if (v, c) in votes and (w, c) in votes]
        if both:
            want["a", v, w] = len(both), sum(votes[v, c] == votes[w, c] for c in both)
    whole = voter_agreement(tiles)
    assert plan(whole).count("Exchange") == plan(whole).split("MapInArrow", 1)[1].count("Exchange")
    for got in (whole, voter_agreement(tiles, square=2), voter_agreement(tiles, square=100)):
        assert {tuple(r)[:3]: tuple(r)[3:] for r in got.collect()} == want
    # six comments are one block: their tiles meet in many tasks nevertheless
    assert voter_agreement(tiles, square=2).select(F.spark_partition_id()).distinct().count() > 4


def test_few_voters_are_spread_by_comments(spark):
    rng = random.Random(7)
    votes = {(v, c): rng.choice([1, -1]) for v in range(5) for c in rng.sample(range(500), 300)}
    tiles = opinion_tiles(spark.createDataFrame([("a", c, v, x) for (v, c), x in votes.items()],
                                                "dataset string, commentId bigint, voterId bigint, vote int"), tile=16)
    got = {tuple(r)[1:3]: tuple(r)[3:] for r in voter_agreement(tiles).collect()}
    for v, w in itertools.combinations(range(5), 2):
        both = [c for c in range(500) if (v, c) in votes and (w, c) in votes]
        assert got.pop((v, w)) == (len(both), sum(votes[v, c] == votes[w, c] for c in both))
    assert not got
