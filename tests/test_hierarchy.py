"""The tree built in rounds equals one merge at a time."""

import random

import numpy as np
import pytest

from polyvox.operators.hierarchy import hierarchy


def one_at_a_time(rows):
    """Average linkage of one dataset, always the nearest two nodes (ties: lowest topics)."""
    terms = sorted({r[1] for r in rows})
    topics = sorted({r[0] for r in rows})
    x = {t: np.zeros(len(terms)) for t in topics}
    for t, term, w in rows:
        x[t][terms.index(term)] = w
    x = {t: v / np.linalg.norm(v) for t, v in x.items()}
    nodes, out, height = {t: ((t,), t) for t in topics}, [], {t: 0.0 for t in topics}
    while len(nodes) > 1:
        d, a, b = min((round(1 - np.mean([x[i] @ x[j] for i in nodes[a][0] for j in nodes[b][0]]), 12), a, b)
                      for a in nodes for b in nodes if a < b)
        height[a] = max(d, height[a], height[b])
        members = tuple(sorted(nodes[a][0] + nodes[b][0]))
        out.append((height[a], len(members), members, nodes[a][0], nodes[b][0]))
        nodes[a] = (members, None)
        del nodes[b]
    ids = {(t,): t for t in topics}
    rows = []
    for k, (h, _, members, left, right) in enumerate(sorted(out)):
        ids[members] = max(topics) + 1 + k
        rows.append((ids[members], list(members), *sorted((ids[left], ids[right])), round(max(h, 0), 9)))
    return rows


def weights(spark, data):
    df = spark.createDataFrame([(d, t, w, float(x)) for d, rows in data.items() for t, w, x in rows],
                               "dataset string, topicId int, term string, weight double")
    return df.unionByName(spark.createDataFrame([(d, -1, "outlier", 1.0) for d in data], df.schema)).repartition(3)


def got_tree(spark, data):
    out = {d: [] for d in data}
    for r in hierarchy(weights(spark, data)).orderBy("dataset", "Parent_ID").collect():
        out[r["dataset"]].append((r["Parent_ID"], r["Topics"], r["Child_Left_ID"], r["Child_Right_ID"], round(r["Distance"], 9)))
    return out


def test_rounds_give_the_same_tree(spark):
    rng = random.Random(2)
    data = {}
    for d, topics, vocabulary in (("dense", 20, 12), ("sparse", 24, 60), ("two", 2, 5), ("one", 1, 4)):
        data[d] = [(3 * t, f"w{w}", rng.random() + 0.01) for t in range(topics) for w in rng.sample(range(vocabulary), 4)]
    # two groups without a common term, and topics that share none with any
    data["apart"] = [(t, f"g{t % 2}{w}", rng.random() + 0.1) for t in range(8) for w in range(3)] + [(90 + t, f"own{t}", 1.0) for t in range(3)]
    got = got_tree(spark, data)
    assert got == {d: one_at_a_time(rows) for d, rows in data.items()}
    assert got["one"] == [] and [r[4] for r in got["apart"]][-4:] == [1.0] * 4


def test_ties_go_to_the_lowest_topics(spark):
    data = {"ties": [(t, w, 1.0) for t in range(6) for w in ("a", "b" if t % 2 else "c")], "equal": [(t, "a", 2.0) for t in range(5)]}
    got = got_tree(spark, data)
    assert [(r[2], r[3]) for r in got["equal"]][0] == (0, 1)
    for d, rows in got.items():
        n = len({t for t, _, _ in data[d]})
        assert len(rows) == n - 1 and rows[-1][1] == list(range(n))
        assert all(x[4] <= y[4] + 1e-12 for x, y in zip(rows, rows[1:]))
        children = [c for r in rows for c in r[2:4]]
        assert sorted(children) == sorted({*range(n), *(r[0] for r in rows[:-1])})


def test_names_sum_over_all_terms(spark):
    rows = [(0, f"t{i:02d}", 1.0 + i / 100) for i in range(40)] + [(1, f"t{i:02d}", 1.0 - i / 100) for i in range(40)] + [(1, "own", 1.5)]
    r, = hierarchy(weights(spark, {"d": rows})).collect()
    assert r["Child_Left_Name"] == "t39_t38_t37_t36_t35" and r["Child_Right_Name"] == "own_t00_t01_t02_t03"
    assert r["Parent_Name"] == "t00_t01_t02_t03_t04"  # each sums to 2; beyond any topic's best terms


@pytest.mark.parametrize("n", [0])
def test_no_topics(spark, n):
    assert hierarchy(weights(spark, {"d": []})).count() == n
