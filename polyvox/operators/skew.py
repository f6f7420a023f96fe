"""Joins that stay balanced when one key holds a large share of the rows.

A hot key (a popular comment, a big topic) would put all its rows into one
shuffle partition. ``salted_join`` finds hot keys with a partial aggregate,
spreads the hot rows of the big side over ``buckets`` salts and copies the
matching rows of the other side once per salt. Cold keys take the ordinary
shuffle join with salt 0, so they cost nothing extra.

The hot-key table is broadcast. Its size is bounded by construction: at
most ``rows(big) / hot_rows`` keys can each have more than ``hot_rows`` rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_HOT_ROWS = 2_000_000
DEFAULT_BUCKETS = 64
_SALT = "__salt"
_HOT = "__hot"


def hot_keys(df: DataFrame, keys: list[str], hot_rows: int) -> DataFrame:
    """Keys with more than ``hot_rows`` rows (at most rows/hot_rows of them)."""
    return (df.groupBy(*keys).count()
            .filter(F.col("count") > hot_rows)
            .select(*keys, F.col("count").alias(_HOT)))


def _conf_int(df: DataFrame, key: str, default: int) -> int:
    try:
        v = df.sparkSession.conf.get(key, None)
    except Exception:  # noqa: BLE001 - conf lookups can be refused on Connect
        v = None
    return int(v) if v else default


def salted_join(big: DataFrame, small: DataFrame, keys: list[str],
                spread_by: list[str], how: str = "inner",
                hot_rows: int | None = None, buckets: int | None = None,
                bucket_rows: int | None = None) -> DataFrame:
    """``big.join(small, keys, how)`` with hot keys of ``big`` split.

    ``spread_by``: columns of ``big`` hashed to pick a salt for hot rows
    (e.g. the voter id), so rows of one hot key land in ``buckets``
    partitions. ``how`` is ``inner`` or ``left`` (rows of ``big`` kept).
    Defaults come from ``polyvox.skew.hotRows`` / ``polyvox.skew.buckets``.
    With ``bucket_rows`` a key has one bucket per so many rows of ``big`` instead: for
    joins of few keys whose rows each make many, where no number of buckets fits all sizes.
    """
    if how not in ("inner", "left"):
        raise ValueError("salted_join supports inner and left joins")
    hot_rows = bucket_rows or hot_rows or _conf_int(big, "polyvox.skew.hotRows", DEFAULT_HOT_ROWS)
    buckets = buckets or _conf_int(big, "polyvox.skew.buckets", DEFAULT_BUCKETS)
    hot = F.broadcast(hot_keys(big, keys, hot_rows))
    is_hot = F.col(_HOT).isNotNull()
    n = F.ceil(F.col(_HOT) / bucket_rows).cast("int") if bucket_rows else F.lit(buckets)
    b = (big.join(hot, keys, "left")
         .withColumn(_SALT, F.when(is_hot, F.pmod(F.xxhash64(*spread_by), n))
                     .otherwise(F.lit(0)).cast("int"))
         .drop(_HOT))
    s = (small.join(hot, keys, "left")
         .withColumn(_SALT, F.explode(F.when(is_hot, F.sequence(F.lit(0), n - 1))
                                      .otherwise(F.array(F.lit(0)))))
         .drop(_HOT))
    return b.join(s, keys + [_SALT], how).drop(_SALT)


#: Statements of a topic that meet its arguments in one bucket.
TOPIC_BUCKET = 2_000


def topic_join(statements: DataFrame, arguments: DataFrame) -> DataFrame:
    """Every statement with every argument of its topic. A statement makes a row per argument, and topics are few, so a
    topic's statements are spread over a bucket per ``TOPIC_BUCKET`` of them; its arguments (about ``2 ln n``) are copied to each."""
    return salted_join(statements, arguments, ["dataset", "topicId"], spread_by=["commentId"], bucket_rows=TOPIC_BUCKET)


def per_dataset(df: DataFrame) -> DataFrame:
    """Broadcast a table with one small row per dataset (a threshold, a count,
    a stop-word list). Its size is #datasets x row size, independent of the
    number of statements or votes; joining it by a shuffle on ``dataset``
    alone would put a whole dataset into one task."""
    return F.broadcast(df)


def per_topic(df: DataFrame) -> DataFrame:
    """A table with one small row per (dataset, topic). Topic counts come from the
    data, so Spark decides by its size whether it is broadcast."""
    return df


#: Rows up to this number are sent to every task (words: about 30 MB).
BROADCAST_ROWS = 1_000_000


def few(df: DataFrame) -> DataFrame:
    """Broadcast a written table if it has at most ``BROADCAST_ROWS`` rows."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df
