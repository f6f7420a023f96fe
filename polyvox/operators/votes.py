"""Vote-log operators: latest vote (E1), tallies (I1, E17), voter views."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polyvox.functions.exprs import agreeability, agreeability_guarded
from polyvox.sources.store import staged

VOTE_KEYS = ["dataset", "commentId", "voterId"]


def latest_vote(log: DataFrame, order: list[str], keys: list[str] | None = None,
                ts: str = "ts", pass_cancels: bool = False) -> DataFrame:
    """Each voter's latest vote per comment.

    ``order`` is the total order of events (time first, then tie-break
    columns). By default passes (vote 0) are dropped *before* taking the
    latest, so a later pass does not cancel an earlier vote; with
    ``pass_cancels`` the latest event wins and keys whose latest is a pass
    are dropped. One partial+final aggregate on the keys: no sort, no window.
    """
    keys = keys or VOTE_KEYS
    src = log if pass_cancels else log.filter(F.col("vote") != 0)
    last = F.max(F.struct(*[F.col(c) for c in order], F.col("vote").alias("__vote")))
    out = (src.groupBy(*keys).agg(last.alias("__last"))
           .select(*keys, F.col("__last.__vote").alias("vote"),
                   F.col(f"__last.{ts}").alias("timestamp")))
    return out.filter(F.col("vote") != 0) if pass_cancels else out


def comment_tally(votes: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Agree / disagree counts and guarded agreeability per comment."""
    keys = keys or ["dataset", "commentId"]
    return (votes.groupBy(*keys)
            .agg(F.count_if(F.col("vote") == 1).alias("agrees"),
                 F.count_if(F.col("vote") == -1).alias("disagrees"))
            .withColumn("agreeability", agreeability_guarded()))


def opinion_matrix(votes: DataFrame) -> DataFrame:
    """Voter x comment opinion matrix in long sparse form, one row per voter.

    ``comments``/``votes`` are parallel arrays ordered by commentId. A voter's
    row holds only the comments they voted on (bounded by the comment count of
    the dataset, not by the number of voters)."""
    return (votes.groupBy("dataset", "voterId")
            .agg(F.sort_array(F.collect_list(F.struct("commentId", "vote"))).alias("__cv"))
            .select("dataset", "voterId",
                    F.col("__cv.commentId").alias("comments"),
                    F.col("__cv.vote").alias("votes"),
                    F.size("__cv").alias("n_votes")))


#: Voters and comments to a side of a tile: a tile holds 65,536 votes at most.
TILE = 256


def opinion_tiles(votes: DataFrame, tile: int = TILE) -> DataFrame:
    """X7, tiled: (dataset, vb, cb, voters, comments, votes), parallel arrays of one tile's votes, sorted.

    Tiles are keyed by blocks of ids (hashed, so that ids with gaps fill them evenly), hence a voter with
    a third of all votes is spread over all comment blocks and no row grows with the data. A vote
    is the latest of its voter on its comment."""
    per_side = lambda c: F.pmod(F.xxhash64(c), F.lit(1 << 31))
    ids = votes.groupBy("dataset").agg(F.approx_count_distinct("voterId").alias("nv"), F.approx_count_distinct("commentId").alias("nc"))
    sized = votes.join(F.broadcast(ids), "dataset")  # a row per dataset
    block = lambda c, n: (per_side(c) % F.greatest(F.ceil(F.col(n) * 2 / tile), F.lit(1))).cast("int")
    return (sized.select("dataset", block("voterId", "nv").alias("vb"), block("commentId", "nc").alias("cb"), "voterId", "commentId", "vote")
            .groupBy("dataset", "vb", "cb").agg(F.array_sort(F.collect_list(F.struct("voterId", "commentId", "vote"))).alias("t"))
            .select("dataset", "vb", "cb", F.col("t.voterId").alias("voters"), F.col("t.commentId").alias("comments"), F.col("t.vote").alias("votes")))


#: Voter blocks to a side of a square of voter pairs: about 2,048 voters, so counts of a square take 32 MB.
SQUARE = 16
#: Pairs of voters that a task gives out at once.
PAIRS = 1 << 17
#: Tasks that the squares of few voters are spread over, by blocks of comments.
SPREAD = 32


def voter_agreement(tiles: DataFrame, square: int = SQUARE) -> DataFrame:
    """(dataset, voter_a, voter_b, both, same): for every two voters a < b with a comment in common, on how many
    comments both voted and on how many of them alike. Votes without voter or comment pair with nothing.

    A blocked matrix product: the voter pairs are cut into squares of ``square`` voter blocks a side. A tile goes to the
    squares of its voters; a square's tiles meet in one task, one block of comments after the other, which holds the
    counts of the square's pairs and gives them out finished. So pairs, which grow with the square of the voters, are
    not shuffled, and neither one block of comments nor one voter is a task of its own. Only squares too few for the
    tasks are also split by blocks of comments, and the partial counts of those pairs summed."""
    tiles = staged(tiles, "tiles")
    size = tiles.groupBy("dataset").agg(F.floor(F.max("vb") / square).alias("last"), (F.max("cb") + 1).alias("ncb"))
    sides = F.col("last") + 1
    squares, ncb = size.agg(F.sum(sides * (sides + 1) / 2).cast("bigint"), F.max("ncb")).first()
    shares = min(ncb or 1, -(-SPREAD // (squares or 1)))
    own = F.floor(F.col("vb") / square)
    met = (tiles.join(F.broadcast(size.select("dataset", "last")), "dataset")  # a row per dataset
           .withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("last"))))
           .select("dataset", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), (F.col("cb") % shares).alias("share"),
                   "cb", "own", "voters", "comments", "votes"))
    key = ["dataset", "lo", "hi", "share"]
    dealt = met.repartition(max(1, min((squares or 1) * shares, 4096)), *key).sortWithinPartitions(*key, "cb")

    def counted(rows: Iterator[dict]) -> Iterator[pa.RecordBatch]:
        """The pairs of one square, from its tiles by blocks of comments."""
        ids: tuple[dict, dict] = ({}, {})  # voters of either side and their places
        both = np.zeros((0, 0), np.int32)
        net = both  # alike minus unlike
        first = None

        def room(a: np.ndarray) -> np.ndarray:
            n, m = (max(len(i), 1) for i in ids)
            if a.shape[0] >= n and a.shape[1] >= m:
                return a
            out = np.zeros([x if x >= y else max(2 * x, y) for x, y in zip(a.shape, (n, m))], a.dtype)
            out[:a.shape[0], :a.shape[1]] = a
            return out

        for _, block in groupby(rows, key=itemgetter("cb")):
            parts: tuple[list, list] = ([], [])
            for r in block:
                first = first or r
                for side, at in enumerate(("lo", "hi")):
                    if r["own"] == r[at]:
                        parts[side].append(r)
            if not (parts[0] and parts[1]):
                continue
            found = []
            for place, part in zip(ids, parts):
                v, c, x = (np.concatenate([p[k] for p in part]) for k in ("voters", "comments", "votes"))
                names, back = np.unique(v, return_inverse=True)
                at = np.array([place.setdefault(n, len(place)) for n in names.tolist()], np.int64)[back]
                found.append((at, c, x))
            known = np.intersect1d(found[0][1], found[1][1])
            both, net = room(both), room(net)
            for lo in range(0, len(known), TILE):
                some, m = known[lo:lo + TILE], []
                for (at, c, x), n in zip(found, both.shape):
                    k = np.minimum(np.searchsorted(some, c), len(some) - 1)
                    hit = some[k] == c
                    dense = np.zeros((n, len(some)), np.float32)  # counts of a block are exact in it
                    dense[at[hit], k[hit]] = x[hit]
                    m.append(dense)
                both += (np.abs(m[0]) @ np.abs(m[1]).T).astype(np.int32)
                net += (m[0] @ m[1].T).astype(np.int32)
        if first is None or not both.size:
            return
        va, vo = (np.array(list(i), np.int64) for i in ids)
        step = max(1, PAIRS // max(len(vo), 1))
        for lo in range(0, len(va), step):
            a = va[lo:lo + step]
            n = both[lo:lo + len(a), :len(vo)]
            seen = n > 0
            if first["lo"] == first["hi"]:  # a square on the diagonal: each pair once
                seen &= a[:, None] < vo[None, :]
            i, j = np.nonzero(seen)
            if len(i):
                n, x, y = n[i, j].astype(np.int64), a[i], vo[j]
                alike = (n + net[lo:lo + len(a), :len(vo)][i, j]) // 2
                yield pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(first["dataset"], pa.string()), len(i)), pa.array(np.minimum(x, y)),
                                                  pa.array(np.maximum(x, y)), pa.array(n), pa.array(alike)],
                                                 ["dataset", "voter_a", "voter_b", "both", "same"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[dict]:
            for b in batches:
                for i in range(b.num_rows):
                    r = {k: b.column(k)[i].as_py() for k in ("dataset", "lo", "hi", "share", "cb", "own")}
                    r |= {k: b.column(k)[i].values for k in ("voters", "comments", "votes")}
                    real = pc.and_(r["voters"].is_valid(), r["comments"].is_valid())
                    yield r | {k: r[k].filter(real).to_numpy() for k in ("voters", "comments", "votes")}
        for _, square_rows in groupby(rows(), key=itemgetter(*key)):
            yield from counted(square_rows)

    pairs = dealt.mapInArrow(run, "dataset string, voter_a bigint, voter_b bigint, both bigint, same bigint")
    if shares == 1:
        return pairs
    return pairs.groupBy("dataset", "voter_a", "voter_b").agg(F.sum("both").alias("both"), F.sum("same").alias("same"))
