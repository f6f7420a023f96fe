"""Near-duplicate classes (X1), density clusters (H3) and components against brute force."""

import math
import random
import time

import numpy as np
import pytest

from polyvox.operators import similar as S
from polyvox.operators.connected import connected

POINTS = "dataset string, commentId bigint, embedding array<double>"


def frame(spark, rows):
    return spark.createDataFrame([(d, i, None if v is None else [float(x) for x in v]) for d, i, v in rows], POINTS).repartition(4)


def unit(rows):
    ok = [(d, i, np.array(v, float)) for d, i, v in rows if v is not None and all(math.isfinite(x) for x in v) and any(v)]
    return [(d, i) for d, i, _ in ok], np.array([v / np.linalg.norm(v) for _, _, v in ok])


def labels(names, near):
    """Smallest id of each connected set, per dataset."""
    root = list(range(len(names)))
    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, j in zip(*np.nonzero(near)):
        if names[i][0] == names[j][0]:
            a, b = find(i), find(j)
            if a != b:
                a, b = sorted((a, b), key=lambda k: names[k][1])
                root[b] = a
    return [names[find(i)][1] for i in range(len(names))]


def brute_classes(rows, threshold):
    names, u = unit(rows)
    got = labels(names, u @ u.T >= threshold)
    return {n: (c, sum(g == c and m[0] == n[0] for g, m in zip(got, names))) for n, c in zip(names, got)}


def brute_density(rows, radius, samples, least):
    names, u = unit(rows)
    ds = np.array([n[0] for n in names])
    d = np.where(ds[:, None] == ds, 1 - u @ u.T, 9.0)
    np.fill_diagonal(d, 0)
    core = np.sort(d, axis=1)[:, samples - 1]
    strong = core <= radius
    lab = labels(names, (d <= radius) & strong[:, None] & strong[None])
    out = {}
    for name in {n[0] for n in names}:
        sizes = {}
        for n, c, s in zip(names, lab, strong):
            if n[0] == name and s:
                sizes[c] = sizes.get(c, 0) + 1
        ids = {c: k for k, (c, _) in enumerate(sorted(((c, v) for c, v in sizes.items() if v >= least), key=lambda x: (-x[1], x[0])))}
        out |= {n: (ids.get(c, -1) if s else -1, round(max(x, 0), 9) if s else None) for n, c, s, x in zip(names, lab, strong, core) if n[0] == name}
    return out


def clouds(seed, copies=40):
    """Unrelated vectors, families of near copies, a third of all rows in one dense family, equal vectors, unusable rows."""
    rng = np.random.default_rng(seed)
    rows, n = [], 0
    for _ in range(120):
        rows.append(("a", n := n + 1, rng.normal(size=24)))
    for f in range(12):
        head = rng.normal(size=24)
        for _ in range(2 + f % 3):
            rows.append(("a" if f % 2 else "b", n := n + 1, head + rng.normal(size=24) * 0.15))
    head = rng.normal(size=24)
    for k in range(copies):
        rows.append(("a", n := n + 1, head + rng.normal(size=24) * (0.02 if k % 2 else 0.3)))
    same = [float(x) for x in rng.normal(size=24)]
    rows += [("a", n := n + 1, same) for _ in range(25)] + [("b", n := n + 1, same), ("b", n := n + 1, [2 * x for x in same])]
    rows += [("a", n := n + 1, None), ("a", n := n + 1, [0.0] * 24), ("b", n := n + 1, [math.nan] * 24)]
    return rows


@pytest.mark.parametrize("block", [S.BLOCK, 8])
def test_classes_equal_all_pairs(spark, block):
    rows = clouds(1, 110)
    got = {(r["dataset"], r["commentId"]): (r["classId"], r["class_size"]) for r in S.near_duplicates(frame(spark, rows), 0.9, block=block).collect()}
    assert got == brute_classes(rows, 0.9)


def test_recall_and_bounded_groups(spark):
    """Linked pairs meet in a group; a bucket that holds a third of the vectors is cut."""
    rows = [(d, i, v) for d, i, v in clouds(2, 110) if v is not None]
    _, reps = S.representatives(frame(spark, rows), "embedding")
    groups = S.bucket_rows(reps, 0.9, block=8)
    held = {}
    for r in groups.select("dataset", "vid", "g").collect():
        held.setdefault(r["g"], set()).add((r["dataset"], r["vid"]))
    met = {p for g in held.values() for p in ((x, y) for x in g for y in g if x < y)}
    names, u = unit([(r["dataset"], r["vid"], r["u"]) for r in reps.collect()])
    near = {(min(names[i], names[j]), max(names[i], names[j])) for i, j in zip(*np.nonzero(np.triu(u @ u.T >= 0.9, 1))) if names[i][0] == names[j][0]}
    assert len(near) > 1000 and near <= met  # recall 1
    assert max(map(len, held.values())) <= 5 * 8  # two blocks dealt by hash


def test_band_plan_follows_rows_and_threshold():
    for n in (10, 10**6, 10**9):
        for t in (0.8, 0.9, 0.97, 1.0):
            bits, bands = S.bits_and_bands(n, t)
            agree = 1 - math.acos(t) / math.pi
            assert (1 - agree ** bits) ** bands <= S.MISS * 1.0001
    assert S.bits_and_bands(10**9, 0.95)[0] > S.bits_and_bands(10**4, 0.95)[0]


def sphere(points):
    return [(x * 0.2, y * 0.2, 1.0) for x, y in points]


def moons(n, gap=0.0):
    a = [(math.cos(t), math.sin(t)) for t in np.linspace(0, math.pi, n)]
    b = [(1 - math.cos(t), 0.5 - math.sin(t) - gap) for t in np.linspace(0, math.pi, n)]
    return a, b


@pytest.mark.parametrize("block", [S.BLOCK, 16])
def test_two_moons_a_bridge_and_outliers(spark, block):
    a, b = moons(60)
    rng = random.Random(3)
    far = [(rng.uniform(-3, 4), rng.choice([-3, 3]) + rng.uniform(-1, 1)) for _ in range(8)]
    rows = [("m", i, v) for i, v in enumerate(sphere(a + b + far))] + [("m", 500, None)]
    bridge = [(x, 0.25) for x in np.linspace(0.0, 1.0, 12)]
    rows += [("bridge", i, v) for i, v in enumerate(sphere(a + b + bridge))]
    radius = 1 - math.cos(0.03)
    for samples in (3, 5):
        got = {(r["dataset"], r["commentId"]): (r["topicId"], None if r["core"] is None else round(r["core"], 9))
               for r in S.density_clusters(frame(spark, rows), radius, samples, min_size=4, block=block).collect()}
        want = brute_density(rows, radius, samples, 4) | {("m", 500): (-1, None)}
        assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()}
        assert all(got[k][1] == pytest.approx(want[k][1], abs=1e-8) for k in want)
    assert len({got["m", i][0] for i in range(120)} - {-1}) == 2


def test_density_of_clouds_counts_copies(spark):
    rows = clouds(5, 60)
    got = {(r["dataset"], r["commentId"]): r["topicId"] for r in S.density_clusters(frame(spark, rows), 0.12, 4, min_size=5, block=16).collect()}
    want = brute_density(rows, 0.12, 4, 5)
    assert {k: got[k] for k in want} == {k: v[0] for k, v in want.items()}
    assert all(got[k] == -1 for k in got.keys() - want.keys()) and len(got) == len(rows)
    assert len({v for v in got.values() if v >= 0}) >= 2


def test_components_of_chains_stars_and_cycles(spark):
    rng = random.Random(9)
    edges = [("x", i, i + 1) for i in range(300)] + [("x", 1000, 1000 + i) for i in range(1, 200)] + [("y", 5, 6), ("y", 6, 7), ("y", 7, 5), ("y", 9, 9)]
    edges += [("z", rng.randrange(100), rng.randrange(100)) for _ in range(60)]
    df = spark.createDataFrame(edges, "dataset string, src bigint, dst bigint")
    names = sorted({(d, x) for d, a, b in edges for x in (a, b) if a != b})
    at = {n: i for i, n in enumerate(names)}
    near = np.zeros((len(names),) * 2, bool)
    for d, a, b in edges:
        if a != b:
            near[at[d, a], at[d, b]] = near[at[d, b], at[d, a]] = True
    rounds = time.time()
    got = {(r["dataset"], r["node"]): r["label"] for r in connected(df).collect()}
    assert got == dict(zip(names, labels(names, near))), time.time() - rounds
    assert connected(df.filter("1 = 0")).count() == 0
    with pytest.raises(RuntimeError):
        connected(df, max_rounds=1)
