"""Weighted support keeps two numbers per voter and topic, not a row per voter and argument."""

import random
from collections import defaultdict

import pytest

from polyvox.operators.scoring import weighted_support


def test_weighted_support_moves_votes_once(spark):
    rng = random.Random(18)
    args = [0, 1, 62, 63, 64, 200, -1]
    edges = [("a", c, c % 2, a, rng.choice(["SUPPORT", "SUPPORT", "UNRELATED"])) for c in range(12) for a in args]
    edges += [("a", 0, 0, 0, "SUPPORT"), ("a", 1, 1, None, "SUPPORT"), ("a", 2, 1, 0, "SUPPORT")]  # twice, without argument, in a second topic
    votes = [("a", c, v, rng.choice([1, -1, 0])) for v in [*range(15), None] for c in rng.sample(range(12), 7)]
    comments = [("a", c, c / 16 if c % 5 else None) for c in range(12)] + [("a", 3, 0.75)]  # one comes twice, one is unknown
    comments.remove(("a", 4, 0.25))
    got = weighted_support(spark.createDataFrame(edges, "dataset string, commentId bigint, topicId int, argumentId bigint, relationship string"),
                           spark.createDataFrame(votes, "dataset string, commentId bigint, voterId bigint, vote int"),
                           spark.createDataFrame(comments, "dataset string, commentId bigint, agreeability double"), min_statements=2)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in plan.splitlines() if "hashpartitioning" in x and "argumentId" in x and "voterId" in x]
    of = defaultdict(list)
    for _, _, v, x in votes:
        of[v].append(x)
    rows, stated = defaultdict(list), defaultdict(set)
    for _, c, t, a, r in edges:
        if r == "SUPPORT" and a is not None:
            stated[t, a].add(c)
            for _, _, v, x in (y for y in votes if y[1] == c and y[3] != 0):
                rows[t, a] += [(v, x, g) for g in [g for _, k, g in comments if k == c] or [None]]
    want = {}
    for k, some in rows.items():
        signs = {v: {x for u, x, _ in some if u == v} for v, _, _ in some}
        lean = [(x, of[v]) for v, x, _ in some if v is not None]
        agreed = [x * g for _, x, g in some if g is not None]
        want[k] = (sum(agreed) if agreed else None, sum(x - sum(o) / len(o) for x, o in lean), sum(x / len(o) for x, o in lean),
                   sum(len(s) == 2 for s in signs.values()) / len(signs), len(signs), len(stated[k]))
    have = {(r["topicId"], r["argumentId"]): tuple(r)[3:] for r in got.collect()}
    want = {k: v for k, v in want.items() if v[-1] >= 2}
    assert have.keys() == want.keys() and len(want) > 8
    for k, v in want.items():
        assert [x is None for x in have[k]] == [x is None for x in v]
        assert [x or 0 for x in have[k]] == pytest.approx([x or 0 for x in v], abs=1e-6)
