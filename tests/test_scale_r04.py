"""The term model moves and writes terms packed (findings F2 to F7, F9, F10 of round 4)."""

import math
import random
from collections import Counter, defaultdict

import pytest

from polyvox.operators import hierarchy as H
from polyvox.operators import packed as P
from polyvox.operators import termblocks as B
from polyvox.operators import text as T
from polyvox.operators import topics as TP

DOCS = "dataset string, commentId bigint, topicId int, commentText string"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def documents(spark):
    rng = random.Random(4)
    words = ["été", "w1", "w2", "w3", "ab", "日本", "x" * 300, *(f"v{i}" for i in range(40))]
    rows = [(d, i, rng.choice([-1, 0, 1, 7]), " ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 2, 5, 40])))) for d in "ab" for i in range(30)]
    rows += [("a", 900, 1, "w1 w2 w1 w2"), ("a", 900, 1, "w1 w2 w1 w2"), ("a", 901, None, "w1"), ("a", 902, 0, None), ("b", None, 1, "w1 ab w1"), (None, 5, 1, "w1 w3")]
    return rows, spark.createDataFrame(rows, DOCS).repartition(3)


def rows_of(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


@pytest.mark.parametrize("held", [7, 1_000_000])
def test_counts_of_words_are_those_of_terms_and_move_packed(spark, monkeypatch, held):
    """one exchange, of packed rows; no row per term and document, and no second one for a term's sum."""
    monkeypatch.setattr(P, "PACKED", held)
    _, df = documents(spark)
    words, terms = T.doc_words(df), T.doc_terms(df)
    got, cols = T.topic_term_counts(words, sums=True), ("dataset", "topicId", "term", "n")
    want = rows_of(T.topic_term_counts(terms), *cols)
    assert rows_of(got, *cols) == want and rows_of(T.topic_term_counts(words), *cols) == want and got.schema[:4] == T.topic_term_counts(terms).schema[:4]
    total, first = Counter(), Counter()
    for d, _, w, n in want:
        total[d, w] += n
    for r in got.collect():
        assert r["term_total"] == total[r["dataset"], r["term"]]
        first[r["dataset"], r["term"]] += r["term_first"]
    assert set(first.values()) == {1}
    assert rows_of(T.topic_totals(words), "dataset", "topicId", "__tot") == rows_of(T.topic_totals(terms), "dataset", "topicId", "__tot")
    weights, idf = T.ctfidf(got, totals=T.topic_totals(words))
    old, old_idf = T.ctfidf(T.topic_term_counts(terms))
    near = lambda df, v, *k: {tuple(r[c] for c in k): pytest.approx(r[v]) for r in df.collect()}
    assert {tuple(r[c] for c in cols[:3]): r["weight"] for r in weights.collect()} == near(old, "weight", *cols[:3])
    assert {(r["dataset"], r["term"]): r["idf"] for r in idf.collect()} == near(old_idf, "idf", "dataset", "term")
    assert "Window" not in plan(weights) and "hashpartitioning(dataset#" in plan(weights)
    assert not any("term#" in x.split(")")[0] for x in plan(weights).split("hashpartitioning(")[1:])


def test_numbers_and_strings_survive_packing():
    import numpy as np
    import pyarrow as pa
    arrays = [np.array([0, -1, 2**62]), np.zeros(0, np.int64), np.array([0.1, -0.0, 0.1, 1e300])]
    got, text = P.load(*P.dump(arrays, "été".encode()))
    assert [a.tolist() for a in got] == [a.tolist() for a in arrays] and text.decode() == "été"
    terms = pa.array(["ab", "ab cd", "日本 x", "a b c", ""])
    at, raw = P.text_of(terms.slice(1))
    assert P.strings(np.diff(at), bytes(raw[at[0]:at[-1]])).to_pylist() == terms.to_pylist()[1:]
    words = pa.array(["ab", "cd"])
    h = P.word_hashes(words)
    assert P.term_bucket(pa.array(["ab", "ab cd"]), 64).tolist() == P.pair_bucket(h[[0, 0]], np.array([0, h[1]], np.uint64), 64).tolist()


@pytest.mark.parametrize("block", [20, 250_000])
def test_representative_docs_are_weighed_in_their_block(spark, monkeypatch, block):
    """documents' terms are not joined with the model; from words and from terms the same documents."""
    monkeypatch.setattr(B, "BLOCK_WORDS", block)
    monkeypatch.setattr(B, "ASKED", block)
    rows, df = documents(spark)
    words = T.doc_words(df)
    weights, idf = T.ctfidf(T.topic_term_counts(words, sums=True), totals=T.topic_totals(words))
    weight, idfs = {(r["dataset"], r["topicId"], r["term"]): r["weight"] for r in weights.collect()}, {(r["dataset"], r["term"]): r["idf"] for r in idf.collect()}
    long, dot, square = defaultdict(float), defaultdict(float), defaultdict(float)
    for (d, t, _), w in weight.items():
        long[d, t] += w * w
    for d, i, t, text in rows:
        own = (text or "").split()
        n = Counter(own) + Counter(f"{a} {b}" for a, b in zip(own, own[1:]))
        if d is not None and t is not None and t >= 0:
            for w, c in n.items():
                x = math.sqrt(c / (2 * len(own) - 1)) * idfs[d, w]
                dot[d, t, i] += x * weight[d, t, w]
                square[d, t, i] += x * x
    best = defaultdict(list)
    for (d, t, i), x in dot.items():
        best[d, t].append((-round(x / math.sqrt(square[d, t, i] * long[d, t]), 9), -1 if i is None else i, i))
    want = {(d, t, k): (i, pytest.approx(-s, abs=1e-6)) for (d, t), v in best.items() for k, (s, _, i) in enumerate(sorted(v, key=lambda r: r[:2])[:3], 1)}
    for source in (words, T.doc_terms(df)):
        out = T.representative_docs(source, weights, idf, 3)
        assert {(r["dataset"], r["topicId"], r["rank"]): (r["commentId"], r["score"]) for r in out.collect()} == want
        assert out.schema["commentId"].dataType.simpleString() == "bigint" and out.schema["topicId"].dataType.simpleString() == "int"
        assert "FlatMapCoGroupsInArrow" in plan(out)


def test_outliers_from_words_are_those_from_terms(spark):
    """blocks of counted terms are made from the words, without a row per term and document."""
    _, df = documents(spark)
    words = T.doc_words(df)
    weights, idf = T.ctfidf(T.topic_term_counts(words, sums=True), totals=T.topic_totals(words))
    assign = df.select("dataset", "commentId", "topicId")
    a, b = (rows_of(T.reassign_by_terms(assign, x, weights, idf), "dataset", "commentId", "topicId") for x in (words, T.doc_terms(df)))
    assert a == b and len([r for r in a if r[2] == -1]) < df.filter("topicId = -1").count()
    block = B.counted_blocks(words.filter("dataset = 'a'").coalesce(1)).first()
    assert not any(" " in w for w in block["terms"]) and max(block["codes"]) < len(block["terms"]) + len(block["left"])


def test_blocks_of_words_are_small(spark, monkeypatch):
    """a task holds one block of 250,000 words and a million products, a reader a few blocks."""
    assert B.BLOCK_WORDS <= 250_000 and B.PRODUCTS <= 1_000_000
    monkeypatch.setattr(B, "BLOCK_WORDS", 10)
    df = spark.createDataFrame([("a", i, -1, "ab cd ef gh ij kl") for i in range(40)], DOCS)
    none = spark.createDataFrame([], "dataset string, word string")
    blocks = B.word_blocks(T.kept_words(df, none).coalesce(1))
    assert blocks.count() == 20 and len(blocks.inputFiles()) >= 20 / B.BLOCKS_PER_FILE
    assert all(not any(" " in w for w in r["terms"]) for r in blocks.collect())


def test_merge_tree_moves_no_term_but_packed(spark):
    """cosines and names are summed where a term's topics are; what is moved is a row per two topics and per node's best terms."""
    rng = random.Random(5)
    rows = [("d", t, f"w{i}", rng.random() + 0.1) for t in range(6) for i in rng.sample(range(60), 25)] + [("d", 3, "w1 w2", 2.0), (None, 1, "w1", 1.0)]
    w = spark.createDataFrame(rows, "dataset string, t int, term string, weight double").repartition(4)
    packed = H.by_term(w)
    by = defaultdict(dict)
    for d, t, term, x in rows[:-1]:
        by[t][term] = by[t].get(term, 0) + x
    got = {(r["a"], r["b"]): r["s"] for r in H.topic_products(packed).collect()}
    want = {(a, b): sum(x * by[b][k] for k, x in by[a].items() if k in by[b]) for a in by for b in by if a <= b}
    assert got == pytest.approx({k: v for k, v in want.items() if v})
    nodes = spark.createDataFrame([("d", 1, [1]), ("d", 9, [0, 1, 3]), ("d", 10, [0, 1, 2, 3, 4, 5])], "dataset string, id int, members array<int>")
    terms = H.node_terms(packed, nodes, 5)
    for id_, members in ((1, [1]), (9, [0, 1, 3]), (10, list(range(6)))):
        total = Counter()
        for t in members:
            total.update(by[t])
        top = sorted(((-round(x, 9), k) for k, x in total.items()))[:5]
        assert sorted((-r["weight"], r["term"]) for r in terms.filter(f"id = {id_}").collect())[:5] == [(pytest.approx(x), k) for x, k in top]
    assert not any("term#" in x.split(")")[0] for x in plan(terms).split("hashpartitioning(")[1:])


def test_keywords_read_the_weights_past_their_candidates(spark):
    """the weights are not dealt anew for the candidates' profiles."""
    rng = random.Random(6)
    w = spark.createDataFrame([("d", t, f"w{i}", rng.random()) for t in range(4) for i in range(50)], "dataset string, topicId int, term string, weight double")
    out = TP.mmr_keywords(w)
    assert "BroadcastHashJoin" in plan(out) and out.count() == 40


@pytest.mark.parametrize("less", [True, False])
def test_dense_vectors_meet_once(spark, monkeypatch, less):
    """where many vectors lie near many, all pairs are compared once in squares; both ways give the same clusters and core distances."""
    import numpy as np

    from polyvox.operators import similar as S
    rng = np.random.default_rng(8)
    centres = rng.integers(-30, 30, (3, 12))
    rows = [(d, int(i), [float(x) for x in centres[i % 3] + rng.integers(-4, 5, 12)]) for d in "ab" for i in range(150)]
    rows += [("a", 500 + i, [float(x) for x in rng.integers(-30, 30, 12)]) for i in range(20)] + [("b", 900, rows[0][2]), ("b", 901, None), ("c", 1, rows[0][2])]
    df = spark.createDataFrame(rows, "dataset string, commentId bigint, embedding array<double>").repartition(3)
    monkeypatch.setattr(S, "ROWS_AT_ONCE", 16)
    monkeypatch.setattr(S, "COLUMNS_AT_ONCE", 24)
    monkeypatch.setattr(S, "all_pairs_cost_less", lambda *a: less)
    if less:
        monkeypatch.setattr(S, "bucket_rows", None)  # no bands, no copies of vectors
    got = {(r["dataset"], r["commentId"]): (r["topicId"], r["core"]) for r in S.density_clusters(df, 0.05, 4, block=32).collect()}
    core = {}
    for d in "abc":
        own = [(i, np.array(v) / np.linalg.norm(v)) for e, i, v in rows if e == d and v]
        for i, u in own:
            near = sorted(max(1 - float(u @ x), 0) for k, x in own if k != i)
            core[d, i] = near[2] if len(near) > 2 and near[2] <= 0.05 else None
    assert {k: v[1] for k, v in got.items() if v[1] is not None} == pytest.approx({k: v for k, v in core.items() if v is not None}, abs=1e-12)
    assert len(got) == len(rows) and len({v[0] for k, v in got.items() if k[0] == "a"} - {-1}) == 3


def test_choice_between_bands_and_all_pairs(spark):
    """the sizes of buckets decide."""
    import numpy as np

    from polyvox.operators import similar as S
    rng = np.random.default_rng(9)
    n = 60_000
    x = rng.standard_normal((n, 24))
    near = np.ones(24) + 0.1 * x
    for v, want in ((x, False), (near, True)):
        v = v / np.linalg.norm(v, axis=1)[:, None]
        reps = spark.createDataFrame(__import__("pandas").DataFrame({"dataset": "d", "u": list(v)}), "dataset string, u array<double>")
        assert S.all_pairs_cost_less(reps, 0.95) is want
