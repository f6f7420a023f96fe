import pytest
from pyspark.sql import functions as F


@pytest.fixture(scope="session")
def awkward(spark):
    """Documents with nulls, empty and long texts, ties, repeated rows and clashing column names."""
    long = " ".join(f"word{i % 977}" for i in range(30_000))
    body = "the quick brown fox jumps over the lazy dog while seven grey geese walk along a quiet river bank today " * 4
    rows = [(1, None), (2, ""), (3, long), (4, long), (4, long), (None, "no id but text enough for words"), (None, None),
            (5, body), (6, body), (7, body.replace("quiet", "loud", 1)), (8, "..."), (9, "one two"), (9, "one two"),
            (10, "One two"), (11, "é" * 3_000), (12, "mail me: jo.doe@example.com or +1 (555) 555-1234\x00end"),
            (13, "<|endoftext|> Ünïcode ﬁ ⅷ İstanbul ‏ <|startoftext|>x's"), (14, "ab" * 400)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    clash = ["lang", "tid", "n", "h", "copies", "piece", "block", "word", "items", "start"]
    return df.select("doc_id", "text", *[F.lit("x").alias(c) for c in clash])


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.filter("1 = 0")
