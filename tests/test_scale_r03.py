"""What moves stays small: band rows hold no vectors, vectors are hashed in their row (F1, F2); terms are counted
where they are read and moved once (F4, F5, F11, F14)."""

import hashlib
import math
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from polyvox.operators import embed as EM
from polyvox.operators import similar as S
from polyvox.operators import text as T

POINTS = "dataset string, commentId bigint, embedding array<double>"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_only_members_of_sets_get_their_vectors(spark):
    rng = np.random.default_rng(4)
    rows = [("a", i, rng.normal(size=16)) for i in range(300)]
    rows += [("a", 1000 + i, rows[i][2] * 2 + rng.normal(size=16) * 1e-3) for i in range(5)]
    _, reps = S.representatives(spark.createDataFrame([(d, i, [float(x) for x in v]) for d, i, v in rows], POINTS), "embedding")
    groups = S.bucket_rows(reps, 0.99)
    assert "BroadcastHashJoin" not in plan(groups)
    assert {r["vid"] for r in groups.select("vid").distinct().collect()} == {*range(5), *range(1000, 1005)}


def test_signed_vectors_are_made_in_their_row(spark):
    docs = spark.createDataFrame([("a", 1, "Ab cd ab. cd"), ("a", 1, "ab"), ("a", None, "Ab cd"), ("a", 3, "x"), ("a", 4, None)],
                                 "dataset string, commentId bigint, commentText string")
    got = EM.signed_embeddings(docs, ngram=1, dims=8)
    assert "Generate" not in plan(got)

    def brute(words):
        v = [0.0] * 8
        for w in words:
            h = hashlib.md5(w.encode()).hexdigest()
            v[int(h[:4], 16) % 8] += 1 if int(h[4], 16) % 2 else -1
        return v
    assert {r["commentId"]: r["embedding"] for r in got.collect()} == {1: brute("ab cd ab cd ab".split()), None: brute(["ab", "cd"])}
    pair = EM.signed_embeddings(docs, ngram=2, dims=8).filter("commentId = 1").first()["embedding"]
    assert pair == brute(["ab cd", "cd ab", "ab cd"])


def test_terms_are_counted_once_and_moved_once(spark):
    """No count of hot terms beside the join; a term's total is taken where its rows are."""
    docs = spark.createDataFrame([("a", 1, 0, "Ab cd ab cd"), ("a", 2, 1, "ab x"), ("a", 2, 1, "cd ef"), ("a", None, 1, "ef"), ("a", 4, -1, "ab"), ("a", 5, 0, None)],
                                 "dataset string, commentId bigint, topicId int, commentText string")
    dterms = T.doc_terms(docs)
    got = sorted((str(r["commentId"]), r["term"], r["n"], r["total"]) for r in dterms.collect())
    assert got == [("1", "ab", 2, 7), ("1", "ab cd", 2, 7), ("1", "cd", 2, 7), ("1", "cd ab", 1, 7), ("2", "ab", 1, 1), ("2", "cd", 1, 3),
                   ("2", "cd ef", 1, 3), ("2", "ef", 1, 3), ("4", "ab", 1, 1), ("None", "ef", 1, 1)]
    counts = T.topic_term_counts(dterms)
    weights, idf = T.ctfidf(counts)
    assert "Window" in plan(weights) 
    n = {(r["topicId"], r["term"]): r["n"] for r in counts.collect()}
    tot = {t: sum(v for (u, _), v in n.items() if u == t) for t in (0, 1)}
    f = lambda w: sum(v for (_, x), v in n.items() if x == w)
    a = math.floor(sum(tot.values()) / 2)
    want = {(t, w): math.sqrt(v / tot[t]) * math.log(1 + a / f(w)) for (t, w), v in n.items()}
    assert {(r["topicId"], r["term"]): r["weight"] for r in weights.collect()} == pytest.approx(want)
    assert "__hot" not in plan(T.representative_docs(dterms, weights, idf)) + plan(T.doc_weights(dterms, idf))


def test_bpe_word_numbers_are_widened_plane_by_plane():
    """Joining a block takes a few times the memory of its word numbers (the pipeline's bpe stage)."""
    from polyvox.llm import bpe
    n, per = 3_000_000, 1000
    numbers = np.arange(n, dtype=np.uint32) % 3
    planes = np.concatenate([(numbers >> s & 0xFF).astype(np.uint8) for s in (0, 8, 16, 24)])
    payload = np.array([3, 1, 2, 1, 7, 8, 9, 7], np.uint32)  # three words: 7, 8 9, 7
    ids = pa.compress(payload.tobytes(), codec="zstd", asbytes=True) + len(payload).to_bytes(8, "little")
    t = pa.table({"kind": [1, 2], "bucket": [0, n], "data": [ids, pa.compress(planes, codec="zstd", asbytes=True)],
                  "doc_ids": [None, list(range(n // per))], "ends": [None, list(range(per, n + 1, per))]})
    del planes, numbers
    tracemalloc.start()
    first = next(bpe._joined(t, {7: "a", 8: "b", 9: "c"}, False))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert first.column("ids")[0].as_py()[:4] == [7, 8, 9, 7] and first.column("decoded")[0].as_py().startswith("a b c a a")
    assert first.column("n_tokens")[0].as_py() == 1333 + (per % 3 > 1) and peak < 16 * n
