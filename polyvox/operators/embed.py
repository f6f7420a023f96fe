"""Vector features (H1, H2, H18, I21) with MLlib transformers.

The default encoder is hashing term frequency, inverse document frequency per
dataset, and unit length: all JVM-side, deterministic, no model download. A model encoder
plugs in through ``encode_with`` (``mapInPandas``, Arrow batches, model
loaded once per Python worker).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import md5

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import PCA, HashingTF, Normalizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polyvox.functions.exprs import tokens
from polyvox.operators.skew import per_dataset


def hash_embeddings(docs: DataFrame, text: str = "commentText", dims: int = 1024,
                    model: str = "hash-tfidf-1024") -> DataFrame:
    """H1: one unit vector per document (whole text) and the encoder id.

    Term frequencies are hashed by MLlib; the document frequency of each hash
    bucket is counted per dataset, so a dataset's vectors don't depend on the
    other datasets of the job. A text without tokens has a zero vector."""
    tok = docs.select("dataset", "commentId", tokens(text).alias("__toks"))
    tf = HashingTF(inputCol="__toks", outputCol="__tf", numFeatures=dims).transform(tok)
    # one row per dataset: a dims-long array
    n, found = F.col("__n"), vector_to_array(F.col("__d"))
    idf = (tf.groupBy("dataset").agg(F.count("*").alias("__n"), Summarizer.numNonZeros(F.col("__tf")).alias("__d"))
           .select("dataset", F.transform(found, lambda d: F.ln((n + 1) / (d + 1))).alias("__w")))
    weighted = (tf.join(per_dataset(idf), "dataset")
                .withColumn("__x", array_to_vector(F.zip_with(vector_to_array(F.col("__tf")), "__w", lambda x, y: x * y))))
    unit = Normalizer(inputCol="__x", outputCol="__v", p=2.0).transform(weighted)
    return unit.select("dataset", "commentId", vector_to_array("__v", "float32").alias("embedding"),
                       F.lit(model).alias("model"))


def signed_embeddings(docs: DataFrame, ngram: int = 1, dims: int = 64, text: str = "commentText") -> DataFrame:
    """H1, portable form: signed feature hashing of ``ngram`` neighbouring words by MD5, so any engine that
    has MD5 computes the same vectors: (dataset, commentId, embedding array<double>).

    A run of words goes to component ``first four hex digits mod dims`` and counts +1 or -1 by the fifth.
    Words are hashed and counted inside their row; what moves is one vector per row, rows of one id are
    summed. A text with fewer words than ``ngram`` has no row."""
    words = docs.select("dataset", F.col("commentId").cast("bigint").alias("commentId"), tokens(text).alias("__t")).filter(F.size("__t") >= ngram)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 256):
                b = whole.slice(lo, 256)
                x = np.zeros((b.num_rows, dims))
                for i, t in enumerate(b.column(2).to_pylist()):
                    runs = t if ngram == 1 else map(" ".join, zip(*[t[k:] for k in range(ngram)]))
                    h = np.frombuffer(b"".join([md5(r.encode()).digest()[:3] for r in runs]), np.uint8).reshape(-1, 3).astype(np.int64)
                    np.add.at(x[i], (h[:, 0] * 256 + h[:, 1]) % dims, np.where(h[:, 2] >> 4 & 1, 1.0, -1.0))
                rows = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, dims, dtype=np.int32)), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), rows], ["dataset", "commentId", "__x"])

    counts = words.mapInArrow(hashed, "dataset string, commentId bigint, __x array<double>")
    return (counts.groupBy("dataset", "commentId").agg(Summarizer.sum(array_to_vector("__x")).alias("__s"))
            .select("dataset", "commentId", vector_to_array("__s").alias("embedding")))


def encode_with(docs: DataFrame, encoder: Callable[[list[str]], np.ndarray],
                text: str = "commentText", model: str = "custom") -> DataFrame:
    """M3: plug-in encoder over Arrow batches (``encoder(texts) -> (n, d)``)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            vecs = encoder(b[text].tolist())
            yield pd.DataFrame({"dataset": b["dataset"], "commentId": b["commentId"],
                                "embedding": [np.asarray(v, dtype=np.float32) for v in vecs],
                                "model": model})
    return docs.select("dataset", "commentId", text).mapInPandas(
        run, "dataset string, commentId bigint, embedding array<float>, model string")


def reduced(points: DataFrame, k: int, vec: str = "embedding") -> DataFrame:
    """H2: (dataset, commentId, embedding) with the first ``k`` principal components, unscaled."""
    p = pca_coords(points, k, vec, scale=False)
    return p.select("dataset", "commentId", F.array(*[f"pc{i + 1}" for i in range(k)]).alias("embedding"))


def pca_coords(points: DataFrame, k: int = 3, vec: str = "embedding",
               scale: bool = True) -> DataFrame:
    """Project vectors on the first ``k`` principal components
    (MLlib PCA: the d x d covariance is aggregated on the cluster, d = vector
    size), then, with ``scale``, min-max scale each component to [0, 1]
    (I21). Fit on all rows given (one dataset per call)."""
    v = points.filter(F.col(vec).isNotNull()).withColumn("__v", array_to_vector(vec))
    model = PCA(k=k, inputCol="__v", outputCol="__p").fit(v)
    p = model.transform(v).select("dataset", "commentId", vector_to_array("__p").alias("__p"))
    cols = [F.get("__p", i).alias(f"pc{i + 1}") for i in range(k)]
    out = p.select("dataset", "commentId", *cols)
    if not scale:
        return out
    names = [f"pc{i + 1}" for i in range(k)]
    mm = out.groupBy("dataset").agg(*[F.min(n).alias(f"__lo{n}") for n in names],
                                    *[F.max(n).alias(f"__hi{n}") for n in names])
    return out.join(per_dataset(mm), "dataset").select(
        "dataset", "commentId",
        *[F.coalesce(F.try_divide(F.col(n) - F.col(f"__lo{n}"), F.col(f"__hi{n}") - F.col(f"__lo{n}")),
                     F.lit(0.0)).alias(n) for n in names])
