"""Operator 3: approximate nearest neighbours with balanced posting lists.

Index: centroids come from a balanced k-means over a bounded sample; they
are searched through an in-memory navigable graph (greedy beam search over
each centroid's nearest centroids plus long links), never by a full scan.
Every vector goes to the posting list of its nearest centroid and, if it
lies near a boundary, also to the lists of further centroids within a
distance ratio, so that a query needs few lists. Lists hold distinct
vectors: equal ones share one entry with their smallest ids, all that a
top-k can name. Lists longer than a block are cut into blocks by hash.

Search: the graph gives a query's nearest centroids; lists farther than a
ratio of the nearest are pruned. Queries and blocks meet by (list, block),
each block returns its top k per query, and the best k over all blocks stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from polyvox.llm.common import staged

SAMPLE = 20_000       # vectors that centroids are fitted on (bounded)
LIST_SIZE = 128       # mean distinct vectors per posting list aimed at
MAX_LISTS = 2_000     # at least ten sampled vectors stand for each centroid
BLOCK_ROWS = 4_096    # rows of a posting list that one block may hold
SHARD_ROWS = 30_000   # postings that are searched in one task
COPIES_RATIO = 1.15   # a vector joins lists whose centroid is within this ratio of its nearest
MAX_COPIES = 4
PROBE_RATIO = 1.6     # lists within this distance ratio of the nearest are searched
MAX_PROBES = 256
MIN_PROBES = 48         # lists searched however near the first is (a query may be a centroid itself)
DEGREE = 24
LONG_LINKS = 8
BEAM = 64


@dataclass
class Centroids:
    """Fitted centroids and their graph; size bounded by MAX_LISTS rows."""

    points: np.ndarray   # (c, d) float64
    links: np.ndarray    # (c, degree) neighbour numbers
    entry: np.ndarray    # entry points

    def search(self, x: np.ndarray, want: int, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
        """For every row of x: numbers and distances of about the ``want`` nearest
        centroids, nearest first, by beam search over the graph (all rows in step)."""
        c = len(self.points)
        want, beam = min(want, c), min(max(beam, want), c)
        norms = (self.points ** 2).sum(1)

        def dist(rows: np.ndarray, ids: np.ndarray) -> np.ndarray:
            xs = x[rows]
            d = norms[ids] - 2 * np.einsum("rd,rkd->rk", xs, self.points[ids]) + (xs ** 2).sum(1)[:, None]
            return np.maximum(d, 0)

        n = len(x)
        seen = np.zeros((n, c), dtype=bool)
        every = np.arange(n)
        first = np.broadcast_to(self.entry, (n, len(self.entry)))
        seen[every[:, None], first] = True
        ids = np.full((n, beam), -1, dtype=np.int64)
        ds = np.full((n, beam), np.inf)
        done = np.ones((n, beam), dtype=bool)

        def merge(rows: np.ndarray, new: np.ndarray, nd: np.ndarray) -> None:
            i = np.concatenate([ids[rows], new], axis=1)
            d = np.concatenate([ds[rows], nd], axis=1)
            f = np.concatenate([done[rows], ~np.isfinite(nd)], axis=1)
            o = np.argsort(d, axis=1, kind="stable")[:, :beam]
            ids[rows], ds[rows], done[rows] = (np.take_along_axis(a, o, 1) for a in (i, d, f))

        merge(every, first, dist(every, first))
        while True:
            rows = np.flatnonzero(~done.all(1))
            if not len(rows):
                break
            at = (~done[rows]).argmax(1)  # nearest not yet expanded
            done[rows, at] = True
            new = self.links[ids[rows, at]]
            nd = np.where(seen[rows[:, None], new], np.inf, dist(rows, new))
            seen[rows[:, None], new] = True
            merge(rows, new, nd)
        return ids[:, :want], np.sqrt(ds[:, :want])


def fit_centroids(sample: np.ndarray, lists: int, rounds: int = 12, seed: int = 7) -> Centroids:
    """Balanced k-means: distances are scaled by a list's fill (fuller lists look
    farther), so that lists come out of similar size; then the centroid graph."""
    rng = np.random.default_rng(seed)
    lists = max(1, min(lists, len(sample)))
    pts = sample[rng.choice(len(sample), lists, replace=False)].astype(np.float64)
    fill = np.ones(lists)
    s2 = (sample ** 2).sum(1)[:, None]
    for _ in range(rounds):
        own = np.empty(len(sample), dtype=np.int64)
        for a in range(0, len(sample), 4096):
            b = slice(a, a + 4096)
            d = np.maximum(s2[b] + (pts ** 2).sum(1) - 2 * sample[b] @ pts.T, 0)
            own[b] = (d * fill).argmin(1)
        size = np.bincount(own, minlength=lists)
        sums = np.zeros_like(pts)
        np.add.at(sums, own, sample)
        some = size > 0
        pts[some] = sums[some] / size[some, None]
        pts[~some] = sample[rng.choice(len(sample), int((~some).sum()))]
        fill = np.clip(0.5 * fill + 0.5 * np.sqrt(np.maximum(size, 1) / max(1.0, len(sample) / lists)), 0.5, 2.0)
    return _linked(np.unique(pts, axis=0), rng)


def _linked(pts: np.ndarray, rng: np.random.Generator) -> Centroids:
    c = len(pts)
    d = (pts ** 2).sum(1)[:, None] + (pts ** 2).sum(1) - 2 * pts @ pts.T
    np.fill_diagonal(d, np.inf)
    near = np.argsort(d, axis=1, kind="stable")[:, :max(1, min(DEGREE, c - 1))] if c > 1 else np.zeros((1, 1), np.int64)
    far = rng.integers(0, c, (c, LONG_LINKS))
    return Centroids(pts, np.concatenate([near, far], axis=1), rng.choice(c, min(c, 8), replace=False))


def valid_vectors(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``vec_id, v``: rows with an id and a usable vector (not null, not zero, no null,
    NaN or infinite component), of the most common length among those (ties: the shorter)."""
    v = F.transform(F.col(vec_col), lambda x: x.cast("double"))
    ok = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists("v", lambda x: x != 0)
    good = (df.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))
            .filter("vec_id is not null and v is not null").filter(F.coalesce(ok, F.lit(False))))
    dims = good.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return good.filter(F.size("v") == F.lit(dims[0] if dims else 0))


def _matrix(col: pa.Array) -> np.ndarray:
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    flat = col.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(col), -1) if len(col) else np.zeros((0, 0))


def nearest(df: DataFrame, k: int = 10, every: int = 100, id_col: str = "vec_id", vec_col: str = "embedding",
            lists: int | None = None, probe_ratio: float = PROBE_RATIO, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest found for each query.

    Queries are the valid rows whose id is divisible by ``every``; candidates
    are all valid rows with another id. ``score`` is the Euclidean distance in
    double precision on the original vectors; ties go to the smaller id, equal
    rows (id and vector) count once. Fewer candidates than k are all returned;
    an empty or unusable table gives no rows. Other columns are ignored.
    """
    spark = df.sparkSession
    out = "query_id long, rank int, vec_id long, score double"
    base = staged(valid_vectors(df, id_col, vec_col).distinct(), "ann-vectors")
    # equal vectors: one entry with the k + 1 smallest ids (any query may be one of them)
    first = Window.partitionBy("v").orderBy("vec_id")
    entries = staged(base.withColumn("r", F.row_number().over(first)).filter(F.col("r") <= k + 1)
                     .groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
                     .withColumn("e", F.xxhash64("v")), "ann-entries")
    n = entries.count()
    if not n:
        return spark.createDataFrame([], out)
    sample = (entries.select("e", "v").orderBy("e").limit(SAMPLE)).toPandas()["v"]
    model = fit_centroids(np.stack(sample.to_numpy()).astype(np.float64),
                          lists or min(MAX_LISTS, max(1, n // LIST_SIZE), max(1, len(sample) // 10)))
    shared = spark.sparkContext.broadcast(model)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            x = _matrix(b.column(1))
            for a in range(0, len(x), 1024):
                ids, ds = m.search(x[a:a + 1024], MAX_COPIES, beam=16)
                keep = np.isfinite(ds) & (ds <= COPIES_RATIO * ds[:, :1] + 1e-12) & (ids >= 0)
                row, col = np.nonzero(keep)
                part = b.slice(a, 1024).take(pa.array(row))
                yield pa.RecordBatch.from_arrays([pa.array(ids[row, col]), *part.columns], ["list", "ids", "v", "e"])

    posts = entries.select("ids", "v", "e").mapInArrow(assign, "list long, ids array<long>, v array<double>, e long")
    posts = staged(posts, "ann-lists")
    sizes = posts.groupBy("list").count().withColumn("blocks", F.ceil(F.col("count") / block_rows).cast("long")).drop("count")
    # one row per list, at most MAX_LISTS
    sizes = F.broadcast(staged(sizes, "ann-sizes"))
    blocks = posts.join(sizes, "list").withColumn("block", F.pmod("e", "blocks")).drop("blocks", "e")

    # equal query vectors are searched once
    asked = staged(base.filter(F.col("vec_id") % every == 0).groupBy("v").agg(F.collect_set("vec_id").alias("qids"))
                   .withColumn("q", F.xxhash64("v")), "ann-queries")

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            x = _matrix(b.column(1))
            for a in range(0, len(x), 256):
                ids, ds = m.search(x[a:a + 256], MAX_PROBES, beam=MAX_PROBES)
                keep = np.isfinite(ds) & (ids >= 0)
                keep[:, MIN_PROBES:] &= ds[:, MIN_PROBES:] <= probe_ratio * ds[:, :1] + 1e-12
                row, col = np.nonzero(keep)
                part = b.slice(a, 256).take(pa.array(row))
                yield pa.RecordBatch.from_arrays([pa.array(ids[row, col]), *part.columns], ["list", "q", "v"])

    probes = (asked.select("q", "v").mapInArrow(probe, "list long, q long, v array<double>").join(sizes, "list")
              .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).drop("blocks"))

    # blocks are dealt to shards of about SHARD_ROWS postings; a shard answers each query once, for
    # all of its lists that the query probes, so answers grow with queries and shards, not with lists
    shards = max(1, -(-posts.count() // SHARD_ROWS))
    shard = F.pmod(F.xxhash64("list", "block"), F.lit(shards)).alias("shard")

    def score(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        got: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        if len(left) and len(right):
            x, ids = np.stack(left["v"].to_numpy()), left["ids"].to_numpy()
            rows = left.groupby(["list", "block"]).indices
            asks = right.groupby(["list", "block"]).indices
            v, q = right["v"].to_numpy(), right["q"].to_numpy()
            for key, own in rows.items():
                part = x[own]
                for i in asks.get(key, ()):
                    d = np.sqrt(((part - v[i]) ** 2).sum(1))
                    # k + 1 entries (the query's own may be one of them) and all ties of the last
                    near = np.flatnonzero(d <= np.partition(d, k)[k]) if len(d) > k + 1 else np.arange(len(d))
                    got.setdefault(q[i], []).append((own[near], d[near]))
        out: dict[str, list] = {"q": [], "ids": [], "score": []}
        for one, parts in got.items():
            at, d = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
            # an entry may lie in several lists of the shard: count copies of the k + 1 by entry
            _, first = np.unique([ids[a][0] for a in at], return_index=True)
            at, d = at[first], d[first]
            keep = np.flatnonzero(d <= np.partition(d, k)[k]) if len(d) > k + 1 else np.arange(len(d))
            out["q"] += [one] * len(keep)
            out["ids"] += [ids[a] for a in at[keep]]
            out["score"] += d[keep].tolist()
        return pd.DataFrame(out).astype({"q": "int64", "score": "float64"})

    found = (blocks.withColumn("shard", shard).groupBy("shard").cogroup(probes.withColumn("shard", shard).groupBy("shard"))
             .applyInPandas(score, "q long, ids array<long>, score double"))
    # a vector in several lists is found several times
    best = found.groupBy("q", "ids").agg(F.min("score").alias("score"))
    pairs = (best.join(asked.select("q", F.explode("qids").alias("query_id")), "q")
             .select("query_id", F.explode("ids").alias("vec_id"), "score").filter("vec_id <> query_id")
             .groupBy("query_id", "vec_id").agg(F.min("score").alias("score")))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return pairs.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")


def exact(df: DataFrame, k: int = 10, every: int = 100) -> pd.DataFrame:
    """Brute force for tests (small tables): the same columns, exactly."""
    rows = {(r[0], tuple(r[1])) for r in valid_vectors(df).collect()}
    ids = np.array([r[0] for r in sorted(rows)])
    x = np.array([r[1] for r in sorted(rows)])
    out = []
    for i in np.flatnonzero(ids % every == 0):
        d = np.sqrt(((x - x[i]) ** 2).sum(1))
        top = [j for j in np.lexsort([ids, d]) if ids[j] != ids[i]][:k]
        out += [(ids[i], r + 1, ids[j], d[j]) for r, j in enumerate(top)]
    return pd.DataFrame(out, columns=["query_id", "rank", "vec_id", "score"])
