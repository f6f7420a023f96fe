"""Table schemas of the data model (survey section 1.4).

Ids and tallies are ``bigint`` (no 65 535 limit), votes and moderation codes
``int``, ratios ``double``. Every table carries ``dataset`` so many
datasets share one table, partitioned by it on disk.
"""

from __future__ import annotations

from pyspark.sql.types import (ArrayType, BooleanType, DoubleType, IntegerType, LongType,
                               StringType, StructField, StructType)

_TYPES = {"string": StringType(), "bigint": LongType(), "int": IntegerType(),
          "double": DoubleType(), "boolean": BooleanType(),
          "array<string>": ArrayType(StringType())}


def _schema(ddl: str) -> StructType:
    """``"name type, ..."`` -> StructType (no session needed at import)."""
    fields = []
    for part in ddl.split(", "):
        name, typ = part.rsplit(" ", 1)
        fields.append(StructField(name.strip("`"), _TYPES[typ], True))
    return StructType(fields)


COMMENTS = _schema(
    "dataset string, commentId bigint, authorId bigint, timestamp bigint, agrees bigint, "
    "disagrees bigint, moderated int, commentText string, agreeability double")
VOTES = _schema(
    "dataset string, commentId bigint, voterId bigint, vote int, timestamp bigint")
TOPICS = _schema("dataset string, Topic int")  # partial: other columns pass through
ARGUMENTS = _schema(
    "dataset string, topicId int, argumentId bigint, argumentTitle string, "
    "argumentContent string, thoughts array<string>")
ARGUMENT_COMMENT_MAP = _schema(
    "dataset string, commentId bigint, topicId int, argumentId bigint, relationship string, "
    "reasoning array<string>")
MODERATION_RESULTS = _schema(
    "dataset string, config int, commentId bigint, languageModelModerated int, "
    "classification string, thoughts array<string>")

# Raw CSV layouts (column names as published in the open data repository).
RAW_COMMENTS = _schema(
    "timestamp bigint, datetime string, `comment-id` bigint, `author-id` bigint, agrees bigint, "
    "disagrees bigint, moderated int, `comment-body` string")
RAW_VOTES = _schema(
    "timestamp bigint, datetime string, `comment-id` bigint, `voter-id` bigint, vote int")
RAW_SUMMARY = _schema("key string, value string")

RELATIONSHIPS = ("SUPPORT", "REFUTE", "UNRELATED")
