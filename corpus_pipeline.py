"""The cleaning pipeline over ``documents``: five stages, each by one operator of ``polyvox.llm``.

Every stage reads what its predecessor wrote and works on all of it. All but
the last return the columns they were given; the last returns token ids.
``run`` writes each stage as Parquet in the shared folder and rereads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from polyvox.llm import bpe, decontaminate, ngram_join, pii, toxicity
from polyvox.llm.common import staged
from polyvox.llm.queries import BPE_TOKENIZER, TOKENIZERS, crc_mod
from polyvox.sources.tables import table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model doesn't reject (score under 0.5)."""
    got = toxicity.scored(docs, table(spark, sf_dir, "labels"), crc_mod(5) != 0, keep=docs.columns)
    return got.filter("predicted = 0").select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (smallest doc_id) of every group of near duplicates."""
    return ngram_join.one_per_class(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without too much of the benchmark."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts masked; ``n_chars`` follows the text."""
    out = pii.redacted(docs)
    if "n_chars" in docs.columns:
        n = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text"))
        out = out.withColumn("n_chars", n.cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document its token ids (and their number and digests of ids and decoded text)."""
    got = bpe.encode_decode(docs, f"{TOKENIZERS}/{BPE_TOKENIZER}")
    return got.select("doc_id", "n_tokens", "ids", F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", one_of_each_group),
    ("decontamination", drop_contaminated),
    ("personal_data", mask_personal_data),
    ("bpe", encode),
]

#: Learnt models, MinHash and tokenizers are beyond SQL; tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
