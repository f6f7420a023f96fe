"""Documents meet the topic model by blocks (F3, F8): brute-force scores, no row per document, term and topic."""

import math
import random
from collections import Counter, defaultdict

import pytest

from polyvox.operators import termblocks as B
from polyvox.operators import text as T

DOCS = "dataset string, commentId bigint, topicId int, commentText string"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def documents(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(14)]
    rows = [(d, i, rng.choice([-1, 0, 1, 2]), " ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 2, 3, 9, 30])))) for d in "ab" for i in range(40)]
    rows += [("a", 900, -1, "w1 w2 w3 w1 w2 w3 w9"), ("a", 900, -1, "w1 w2 w3 w1 w2 w3 w9"), ("b", None, -1, "w1 w2"), ("a", 901, -1, None), ("b", 902, -1, "zz yy")]
    return rows, spark.createDataFrame(rows, DOCS)


def terms_of(w):
    return Counter(w) + Counter(f"{a} {b}" for a, b in zip(w, w[1:]))


def model(spark, df):
    weights, idf = T.ctfidf(T.topic_term_counts(T.doc_terms(df)))
    by = defaultdict(dict)
    for r in weights.collect():
        by[r["dataset"], r["topicId"]][r["term"]] = r["weight"]
    return weights, idf, by, {(r["dataset"], r["term"]): r["idf"] for r in idf.collect()}


@pytest.fixture(params=[25, 500_000])
def block_words(request, monkeypatch):
    monkeypatch.setattr(B, "BLOCK_WORDS", request.param)
    monkeypatch.setattr(B, "PRODUCTS", request.param)
    return request.param


def test_terms_of_outliers_take_the_best_topic(spark, block_words):
    rows, df = documents(spark)
    weights, idf, by, idfs = model(spark, df)
    want = {}
    for d, i, t, text in rows:
        best = None
        if t == -1 and i is not None and text:
            n = terms_of(text.split())
            total = sum(n.values())
            sums = {u: sum(math.sqrt(c / total) * idfs[d, w] * by[d, u][w] for w, c in n.items() if w in by[d, u]) for u in (0, 1, 2)}
            best = max(((round(s, 9), -u) for u, s in sums.items() if s > 0), default=None)
        want[d, i] = t if t != -1 or best is None else -best[1]
    out = T.reassign_by_terms(df.select("dataset", "commentId", "topicId"), T.doc_terms(df), weights, idf)
    assert {(r["dataset"], r["commentId"]): r["topicId"] for r in out.collect()} == want and out.count() == len(rows)
    # a row per document and topic leaves a block, none per term
    assert "FlatMapCoGroupsInArrow" in plan(out) and "dweight" not in plan(out)


@pytest.mark.parametrize(("size", "stride"), [(4, 1), (3, 2), (1, 1)])
def test_windows_are_weighed_in_their_block(spark, block_words, size, stride):
    rows, df = documents(spark)
    weights, idf, by, idfs = model(spark, df)
    length = {k: math.sqrt(sum(x * x for x in v.values())) for k, v in by.items()}
    windows = defaultdict(Counter)
    for d, i, _, text in rows:
        w = (text or "").split()
        if i is not None and w:
            for s in range(0, max(len(w) - size + 1, 1), stride):
                windows[d, i, s] += terms_of(w[s:s + size])
    want = defaultdict(float)
    for (d, i, _), n in windows.items():
        total = sum(n.values())
        v = {w: math.sqrt(c / total) * idfs[d, w] for w, c in n.items() if (d, w) in idfs}
        for u in (0, 1, 2):
            shared = [w for w in v if w in by[d, u]]
            cosine = sum(v[w] * by[d, u][w] for w in shared) / (math.sqrt(sum(x * x for x in v.values())) * length[d, u]) if shared else 0
            if cosine >= 0.1:
                want[d, i, u] += cosine
    none = spark.createDataFrame([], "dataset string, word string")
    got = T.topic_distributions(df, none, weights, idf, size, stride).collect()
    assert {(r["dataset"], r["commentId"], r["topicId"]): r["score"] for r in got} == pytest.approx(dict(want)) and len(got) == len(want)


def test_a_block_is_written_once_with_its_distinct_terms(spark):
    _, df = documents(spark)
    blocks = B.counted_blocks(T.doc_terms(df.filter("dataset = 'a'")).coalesce(1)).collect()
    assert len(blocks) == 1 and len(set(blocks[0]["terms"])) == len(blocks[0]["terms"]) < len(blocks[0]["codes"]) / 2
    assert T.topic_distributions(
        df.filter("1 = 0"), spark.createDataFrame([], "dataset string, word string"), *T.ctfidf(T.topic_term_counts(T.doc_terms(df)))).count() == 0


def test_bpe_blocks_of_ids_are_smaller_than_those_of_digests(spark, monkeypatch):
    """Pipeline: ids of a block are held as lists, so its blocks are smaller; the results don't depend on blocks."""
    import hashlib

    from polyvox.llm import bpe
    from polyvox.llm.queries import BPE_TOKENIZER, TOKENIZERS
    assert bpe.ID_BLOCK_CHARS * 4 <= bpe.BLOCK_CHARS
    monkeypatch.setattr(bpe, "ID_BLOCK_CHARS", 40)
    docs = spark.createDataFrame([(1, "One and two, and one."), (2, None), (2, "Äther <|x|> 12"), (None, "and " * 50), (4, "")], "doc_id bigint, text string").coalesce(1)
    path = f"{TOKENIZERS}/{BPE_TOKENIZER}"
    ids = bpe.encode_decode(docs, path, buckets=3).collect()
    digests = bpe.encode_decode(docs, path, buckets=3, digests=True).collect()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    key = lambda r: tuple(map(str, r))
    assert sorted(((r["doc_id"], r["n_tokens"], sha(" ".join(map(str, r["ids"]))), sha(r["decoded"])) for r in ids), key=key) == sorted(map(tuple, digests), key=key)
