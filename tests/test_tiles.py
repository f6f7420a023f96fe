"""Tiles hold every vote once, agreement counts equal brute force, a dominant voter is spread."""

import itertools
import random

from polyvox.operators.votes import opinion_tiles, voter_agreement


def test_tiles_and_agreement(spark):
    rng = random.Random(4)
    votes = {(d, v, c): rng.choice([1, -1]) for d in ("a", "b") for v in range(40) for c in rng.sample(range(300), 12)}
    votes |= {("a", 999, c): rng.choice([1, -1]) for c in range(300)}  # about a third of all votes
    df = spark.createDataFrame([(d, c, v, x) for (d, v, c), x in votes.items()], "dataset string, commentId bigint, voterId bigint, vote int")
    tiles = opinion_tiles(df, tile=16)
    rows = tiles.collect()
    assert {(r["dataset"], v, c): x for r in rows for v, c, x in zip(r["voters"], r["comments"], r["votes"])} == votes
    assert sum(len(r["votes"]) for r in rows) == len(votes)
    assert sum(999 in r["voters"] for r in rows) > 10 and max(len(r["votes"]) for r in rows) < 120
    want = {}
    for (d, v, c), x in votes.items():
        for w in itertools.chain(range(v + 1, 40), [999] if v != 999 else []):
            if (d, w, c) in votes:
                both, same = want.get((d, v, w), (0, 0))
                want[d, v, w] = both + 1, same + (votes[d, w, c] == x)
    got = {tuple(r)[:3]: tuple(r)[3:] for r in voter_agreement(tiles).collect()}
    assert got == want
    assert voter_agreement(opinion_tiles(df.filter("1 = 0"))).count() == 0
