"""Centroid clustering with Ptolemaic pivots.

Euclidean space obeys Ptolemy's inequality: for a pivot pair (p, s), a vector x and a centroid c

    d(x, c) * d(p, s) >= |d(x, p) * d(c, s) - d(x, s) * d(c, p)|

so each pair bounds d(x, c) from below without touching x's components. Distances from vectors
to the pivots are computed once and cached in a table beside the integer vectors; distances from
centroids to pivots are found anew each round (k x pivots numbers). Per vector, the centroid with the
lowest bound is measured exactly, every centroid whose bound surely exceeds that distance is
dropped, and the survivors are measured exactly in 64-bit integers. Bounds are computed in
double precision and rounded down by more than their largest possible error, so none that ties or wins is ever
dropped: assignments are exactly those of a full comparison.

Spark's share: one scan per round in which a task keeps k partial sums, a groupBy on the cluster,
and k rows to the driver. Vectors and cached distances are written once to the shared folder
and re-read each round. Pivots, pairs and centroids are k x dimensions numbers, whatever the
number of rows.

Defined results. Vectors that are null, don't have exactly ``dims`` components or hold null or non-finite
ones are left out. Repeated rows each count. Seeds are the k rows with the smallest SHA-256 of
``1:<vec_id>``, repeated ids in order of their vectors, null ids never; with fewer rows there are
fewer centroids (if only null ids are left, no row is returned). Ties go to the smaller
number; empty centroids stay. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polyvox.llm.common import staged
from polyvox.llm.vectors import digest, finite, floors, summed

CLUSTERS = 16
ROUNDS = 3
SCALE = 64
DIMS = 64
#: Fixed pivots (spread-out seeds); every two of them are a pair.
PIVOTS = 5
#: Components of this size still have squared distances within 64 bits for up to 64 components; see _limit.
_ROOM = 2 ** 30
#: More than the relative rounding error of a bound: seven operations of at most 2^-53 each.
_SLACK = 2.0 ** -48


def _limit(dims: int) -> int:
    """Components under this keep dims * (2 c)^2 inside 64 bits."""
    return int(_ROOM / max(1, dims) ** 0.5)


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of ``x`` from one integer vector."""
    d = x - c
    return (d * d).sum(-1)


def choose_pivots(seeds: np.ndarray, count: int = PIVOTS) -> np.ndarray:
    """Up to ``count`` different seeds, each the farthest from those before (ties: first)."""
    chosen = [0] if len(seeds) else []
    while chosen and len(chosen) < count:
        gap = np.min([squared(seeds, seeds[i]) for i in chosen], axis=0)
        if not gap.max():
            break
        chosen.append(int(gap.argmax()))
    return seeds[chosen]


def lower_bounds(to_pivots: np.ndarray, centroid_pivots: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """n x k lower bounds of distances, never above the true ones: the largest Ptolemaic bound over
    all pivot pairs, from squared distances of vectors (n x P) and centroids (k x P) to the pivots."""
    a, b = np.sqrt(to_pivots.astype(np.float64)), np.sqrt(centroid_pivots.astype(np.float64))
    best = np.zeros((len(a), len(b)))
    for i in range(len(pivots)):
        for j in range(i):
            u, v = a[:, i, None] * b[:, j], a[:, j, None] * b[:, i]
            gap = np.abs(u - v) - (u + v) * _SLACK  # the difference is exact but for errors in u and v
            np.maximum(best, gap / np.sqrt(float(squared(pivots[i], pivots[j]))) * (1 - _SLACK), out=best)
    return best


def assign(x: np.ndarray, to_pivots: np.ndarray, centroids: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid of each row (ties: smaller number), the squared distance, and how many
    distances were measured."""
    near = np.stack([squared(centroids, p) for p in pivots], axis=1)
    low = lower_bounds(to_pivots, near, pivots)
    first = low.argmin(1)
    most = squared(x, centroids[first])
    alive = low * low * (1 - _SLACK) <= most[:, None].astype(np.float64) * (1 + _SLACK)
    alive[np.arange(len(x)), first] = True
    best, at = np.full(len(x), np.iinfo(np.int64).max), np.zeros(len(x), np.int32)
    for c in range(len(centroids)):
        rows = np.flatnonzero(alive[:, c])
        d = squared(x[rows], centroids[c])
        better = d < best[rows]
        at[rows[better]], best[rows[better]] = c, d[better]
    return at, best, int(alive.sum())


def prepared(vectors: DataFrame, id: str, vec: str, dims: int, scale: int) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """The table ``(id, q, near)`` of integer vectors with cached squared pivot distances, the
    seeds and the pivots."""
    rows = (vectors.select(F.col(id).alias("id"), F.col(vec).alias("vec"))
            .filter((F.size("vec") == dims) & finite("vec")))
    key = F.sha2(F.concat(F.lit("1:"), F.col("id").cast("string")), 256)
    found = (rows.filter("id is not null").select(key.alias("h"), "vec").orderBy("h", "vec").limit(CLUSTERS)
             .select("vec").collect())
    seeds = floors(pa.array([r["vec"] for r in found], pa.list_(pa.float64())), dims, scale, _limit(dims))
    pivots = choose_pivots(seeds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = floors(b.column(1), dims, scale, _limit(dims))
            near = np.stack([squared(x, p) for p in pivots], axis=1) if len(pivots) else np.zeros((len(x), 0), np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), _lists(x), _lists(near)], ["id", "q", "near"])

    table = rows.mapInArrow(run, f"id {dict(rows.dtypes)['id']}, q array<long>, near array<long>")
    return staged(table, "pivots"), seeds, pivots


def _lists(x: np.ndarray) -> pa.Array:
    off = np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]
    return pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(x.ravel()))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.int64).reshape(len(column), width)


def cluster(vectors: DataFrame, id: str = "vec_id", vec: str = "embedding", dims: int = DIMS, scale: int = SCALE,
            rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """Clusters of all usable vectors: ``(vec_id, cluster int, distance long)`` and the final centroids."""
    table, centroids, pivots = prepared(vectors, id, vec, dims, scale)
    sc = table.sparkSession.sparkContext
    width = len(pivots)

    def sums(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            now = shared.value
            total, count = np.zeros_like(now), np.zeros(len(now), np.int64)
            for b in batches:
                x = _matrix(b.column(0), dims)
                at, _, _ = assign(x, _matrix(b.column(1), width), now, pivots)
                np.add.at(total, at, x)
                count += np.bincount(at, minlength=len(now))
            c = np.flatnonzero(count)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32()), pa.array(count[c]), _lists(total[c])], ["cluster", "n", "s"])
        return run

    def final(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                at, d, _ = assign(_matrix(b.column(1), dims), _matrix(b.column(2), width), shared.value, pivots)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(at), pa.array(d)], ["id", "cluster", "distance"])
        return run

    if not len(centroids):  # no row with an id
        return table.filter("1 = 0").select(F.col("id").alias(id), F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), centroids
    for _ in range(rounds):
        shared = sc.broadcast(centroids)
        centroids = centroids.copy()
        for r in summed(table.select("q", "near").mapInArrow(sums(shared), "cluster int, n long, s array<long>"), ["cluster"], dims):
            centroids[r["cluster"]] = [r[f"s{i}"] // r["n"] for i in range(dims)]
        shared.unpersist()
    out = table.mapInArrow(final(sc.broadcast(centroids)), f"id {dict(table.dtypes)['id']}, cluster int, distance long")
    return staged(out, "clusters").toDF(id, "cluster", "distance"), centroids


def clustered(vectors: DataFrame) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every usable vector."""
    got, centroids = cluster(vectors)
    # CLUSTERS rows at most
    sums = {r["cluster"]: r["s"] for r in got.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    about = got.sparkSession.createDataFrame(
        [(c, s, sum(sums.values()), digest(centroids[c])) for c, s in sums.items()],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return got.join(F.broadcast(about), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
