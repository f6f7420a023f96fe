"""WARC archives, nearest neighbours and the pipeline."""

import base64
import hashlib
import random

import pyarrow.fs as pafs
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from polyvox.llm import decontaminate, ngram_join, pii, spann, toxicity, warc
from polyvox.llm.common import components, shared_folder
from polyvox.llm.queries import crc_mod

SMALL = "/root/testdata/sf0.001"


def nested(record: bytes) -> str:
    return record.decode("latin-1")


def page_rows():
    fake = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:777>\r\nContent-Length: 4\r\n\r\nabcd\r\n\r\n"
    rng = random.Random(2)
    rows = [(1, "http://a/", "same"), (2, "http://b/", "same"), (9, None, "same"), (3, "u v\r\nX: y", None), (4, "d", ""),
            (5, "e", fake * 3), (6, "f", "x" * 5000 + fake + "é" * 100), (None, "g", "same"), (10, "h", "once"), (10, "h", "once"),
            (11, "i", "\x1f\x8b\x08" * 50)]
    return rows + [(100 + i, f"http://p/{i}", "".join(rng.choice("ab<>/p \n") for _ in range(rng.randrange(3000)))) for i in range(60)]


@pytest.mark.parametrize("compress", [True, False])
@pytest.mark.parametrize("range_bytes", [700, 4 << 20])
def test_warc_roundtrip(spark, compress, range_bytes):
    rows = page_rows()
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("file", F.lit("clash"))
    got = sorted((tuple(r) for r in warc.roundtrip(spark, pages, compress=compress, range_bytes=range_bytes)
                  .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)
    want = []
    for i, _, h in rows:
        p = (h or "").encode()
        kept = max(j for j, _, x in rows if (x or "") == (h or "") and j is not None)
        own = i is None or i == kept
        want.append((i, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "response" if own else "revisit", None if own else kept))
    assert got == sorted(want, key=str)


def test_warc_small_payloads_are_all_responses(spark):
    pages = spark.createDataFrame([(1, "a", "xy"), (2, "b", "xy"), (3, "c", "long enough"), (4, "d", "long enough")], "page_id long, url string, html string")
    got = {r["page_id"]: r["record_type"] for r in warc.roundtrip(spark, pages, min_revisit_bytes=5).collect()}
    assert got == {1: "response", 2: "response", 3: "revisit", 4: "response"}
    assert warc.roundtrip(spark, pages.filter("1 = 0")).count() == 0


def test_warc_verifies_payloads_and_stops_at_damage(spark):
    pages = spark.createDataFrame([(i, "u", f"payload {i} " * 50) for i in range(20)], "page_id long, url string, html string")
    folder = shared_folder(spark, "warc-test")
    files = warc.write_archives(warc.records(pages).coalesce(1), folder, compress=False)
    fs, _ = pafs.FileSystem.from_uri(folder)
    path = files.first()["file"]
    data = bytearray(fs.open_input_file(path).read())
    at = data.index(b"payload 7 ")
    data[at:at + 7] = b"PAYLOAD"
    cut = data.index(b"WARC/1.1", data.index(b"<urn:page:15>"))
    data[cut:cut + 4] = b"XXXX"
    with fs.open_output_stream(path, compression=None) as f:
        f.write(bytes(data))
    got = {r["page_id"]: r["verified"] for r in warc.read_archives(files, folder, 900).collect()}
    assert got[7] is False and all(v for k, v in got.items() if k != 7) and 15 in got and 16 not in got


# --- nearest neighbours ------------------------------------------------------

def test_nearest_small_table_is_exact(spark):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(0, 700)]
    rows += [(1000 + i, rows[100][1]) for i in range(30)]      # many equal vectors
    rows += [(100, rows[100][1]), (2000, None), (2100, [0.0] * 8), (2200, [float("nan")] * 8), (2300, [1.0, None] + [0.0] * 6),
             (2400, [float("inf")] + [0.0] * 7), (None, [1.0] * 8), (2500, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("list", F.lit(0)).withColumn("q", F.lit(0))
    got = spann.nearest(df, block_rows=16).toPandas().sort_values(["query_id", "rank"]).reset_index(drop=True)
    want = spann.exact(df).sort_values(["query_id", "rank"]).reset_index(drop=True)
    assert got[["query_id", "rank", "vec_id"]].values.tolist() == want[["query_id", "rank", "vec_id"]].values.tolist()
    assert abs(got.score - want.score).max() < 1e-12
    few = spann.nearest(df.filter("vec_id in (0, 1, 2)")).collect()
    assert [(r["query_id"], r["rank"]) for r in sorted(few)] == [(0, 1), (0, 2)]
    assert spann.nearest(df.filter("1 = 0")).count() == 0


def test_nearest_recall(spark):
    e = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = {(r["query_id"], r["vec_id"]) for r in spann.nearest(e).collect()}
    want = set(spann.exact(e)[["query_id", "vec_id"]].itertuples(index=False, name=None))
    assert len(got & want) >= 0.9 * len(want)


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (7, 7), (200, 101), (102, 100)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | dict.fromkeys((100, 101, 102, 200), 100)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- pipeline ----------------------------------------------------------------

def test_pipeline_stages_equal_their_operators(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    stage = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "personal_data", "bpe"]
    out = stage["toxicity"](spark, docs, SMALL)
    rejected = {r["doc_id"] for r in toxicity.scored(docs, labels, crc_mod(5) != 0).filter("predicted = 1").collect()}
    assert {r["doc_id"] for r in out.collect()} == {r["doc_id"] for r in docs.collect()} - rejected
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    out = stage["near_duplicates"](spark, docs, SMALL)
    assert {r["doc_id"] for r in out.collect()} == {c for c, _ in ngram_join.exact_join(texts).values()}
    out = stage["decontamination"](spark, docs, SMALL)
    gone = {r["doc_id"] for r in decontaminate.contamination(docs, bench).filter("contaminated").collect()}
    assert {r["doc_id"] for r in out.collect()} == set(texts) - gone
    out = stage["personal_data"](spark, docs, SMALL)
    assert out.schema == docs.schema
    for r in out.collect():
        assert r["text"] == pii.redact(texts[r["doc_id"]], pii.find_spans(texts[r["doc_id"]])[1]) and r["n_chars"] == len(r["text"])
    got = corpus_pipeline.run(spark, SMALL)
    assert 0 < got.count() < docs.count() and got.filter("n_tokens <> size(ids)").count() == 0


def test_pipeline_stages_take_awkward_rows(spark, awkward, nothing):
    for name, f in corpus_pipeline.STAGES:
        out = f(spark, awkward, SMALL)
        assert out.count() > 0, name
        if name != "bpe":
            assert out.columns == awkward.columns, name
        assert f(spark, nothing, SMALL).count() == 0, name
