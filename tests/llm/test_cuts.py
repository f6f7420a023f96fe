"""Cases that limits once cut off: long headers, other scripts' digits, long names, large alphabets."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from polyvox.llm import bpe, langid, pii, queries, warc


@pytest.mark.parametrize("compress", [True, False])
def test_headers_of_any_length(spark, compress):
    url = "http://example.org/" + "x" * 200_000
    pages = spark.createDataFrame([(1, "http://a.org/", "one"), (2, url, "two"), (3, "http://b.org/", "three")], "page_id long, url string, html string")
    got = {r["page_id"]: r for r in warc.roundtrip(spark, pages.coalesce(1), compress=compress).collect()}
    assert sorted(got) == [1, 2, 3] and got[2]["url"] == url and all(r["verified"] for r in got.values())
    assert got[3]["payload_bytes"] == 5


def test_digits_of_any_script():
    for t in ("call +۱ ۵۵۵ ۵۵۵ ۱۲۳۴ now", "+१५५५५५५१२३४", "+１５５５５５５１２３４", "+𝟏𝟓𝟓𝟓𝟓𝟓𝟓𝟏𝟐𝟑𝟒"):
        (kind, s, e), = pii.find_disguised(t, pii.find_base(t))
        assert kind == "phone" and t[s:e].strip() == t[s:e] and sum(c.isdigit() for c in t[s:e]) == 11


def test_names_of_many_parts():
    name = " point ".join("abcdefghijklmnop")
    t = f"ecrire a {name} arobase exemple point com merci"
    (kind, s, e), = pii.find_disguised(t, pii.find_base(t))
    assert kind == "email" and t[s:e] == f"{name} arobase exemple point com"
    assert pii.find_disguised("at this point we met @ noon at point b", []) == []


def test_scripts_keep_their_letters_apart():
    for lo, hi in ((0x4E00, 0x9FA6), (0xAC00, 0xD7A4), (0x3041, 0x30FF), (0x400, 0x530)):
        cp, _ = langid._codes([chr(c) for c in range(lo, hi)])
        assert len(np.unique(cp)) == hi - lo + 1  # and the edge


def test_kneser_ney_equals_a_dictionary():
    words = ["the", "then", "there", "hat", "that", "that", "ab", "é", "語", "語言"]
    cp, off = langid._codes(words)
    g, n = np.unique(langid._grams(cp, off), return_counts=True)
    model = langid.kneser_ney(g, n)
    order, d = langid.ORDER, langid.DISCOUNT
    split = lambda x, k: tuple(int(x) >> langid.BITS * i & (1 << langid.BITS) - 1 for i in range(k - 1, -1, -1))
    levels = {order: {split(x, order): int(c) for x, c in zip(g, n)}}
    for k in range(order - 1, 0, -1):
        before = {}
        for x in levels[k + 1]:
            before.setdefault(x[1:], set()).add(x[0])
        levels[k] = {x: len(v) for x, v in before.items()}

    def p(x):
        k = len(x)
        if k == 0:
            return 1 / (1 << langid.BITS)
        after = {y: c for y, c in levels[k].items() if y[:-1] == x[:-1]}
        if not after:
            return p(x[1:])
        total = sum(after.values())
        return max(after.get(x, 0) - d, 0) / total + d * len(after) / total * p(x[1:])
    rng = np.random.default_rng(0)
    unseen = [sum(int(c) << langid.BITS * i for i, c in enumerate(rng.choice(cp, order))) for _ in range(200)] + [7]
    for x in [*g.tolist(), *unseen]:
        assert model.score(np.array([x]))[0] == pytest.approx(math.log(p(split(x, order))), abs=1e-9)


def test_buckets_follow_the_text(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "some words here and there " * 50) for i in range(20)], "doc_id long, text string")
    path = f"{queries.TOKENIZERS}/{queries.BPE_TOKENIZER}"
    want = sorted(map(tuple, bpe.encode_decode(docs, path, digests=True).collect()))
    monkeypatch.setattr(bpe, "BUCKETS", 1)
    monkeypatch.setattr(bpe, "BUCKET_CHARS", 1000)
    assert sorted(map(tuple, bpe.encode_decode(docs, path, digests=True).collect())) == want
    assert bpe.encode_decode(docs.filter("1 = 0"), path).count() == 0


def test_damaged_payloads_are_refused(spark, monkeypatch, tmp_path):
    docs = spark.createDataFrame([(1, "http://a.org/", "one")], "page_id long, url string, html string")
    docs.write.parquet(f"{tmp_path}/pages.parquet")
    assert queries.op1_warc(spark, str(tmp_path)).count() == 1
    read = warc.read_archives
    monkeypatch.setattr(warc, "read_archives", lambda *a: read(*a).withColumn("verified", F.lit(False)))
    with pytest.raises(Exception, match="damaged payload"):
        queries.op1_warc(spark, str(tmp_path)).collect()
