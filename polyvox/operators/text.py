"""Topic text analytics.

Terms are lower-cased tokens of two or more letters/digits; stop words are
removed first and bigrams are formed from the remaining neighbours. Stop
words are a table (dataset, word): the words of the dataset title (H6) and
whatever a caller adds. A document-frequency cut (``max_df``) can be asked
for; by default there is none, so small datasets lose no terms.

c-TF-IDF (class-based TF-IDF with frequent-word damping), per dataset:

    n(t,w)  count of term w in topic t        tot(t) = sum_w n(t,w)
    A       floor(mean_t tot(t))              f(w)   = sum_t n(t,w)
    weight  sqrt(n(t,w) / tot(t)) * ln(1 + A / f(w))

Words are found inside the row (a built-in regex and array functions), paired and counted by Arrow
where they are read; all other steps are grouped aggregates, joins and one window per term.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from polyvox.functions.exprs import tokens
from polyvox.operators import packed as P
from polyvox.operators.skew import few, per_dataset, per_topic, salted_join
from polyvox.operators.termblocks import counted_blocks, own_topic_scores, scores, term_model, whole_text_scores, window_scores, word_blocks
from polyvox.sources.store import staged

MAX_DF = 0.5

# Stop words of all datasets together up to this number are sent to every task (about 30 MB).
BROADCAST_WORDS = 1_000_000


def title_stop_words(summary: DataFrame) -> DataFrame:
    """H6: words of each dataset's title, split on non-word characters."""
    return (summary.filter(F.col("key") == "topic")
            .select("dataset", F.explode(F.split(F.lower("value"), r"[^\p{L}\p{N}_]+")).alias("word"))
            .filter(F.length("word") > 0).distinct())


def doc_tokens(docs: DataFrame, text: str = "commentText") -> DataFrame:
    """Tokens of each document as an array column ``toks`` (whole text)."""
    return docs.withColumn("toks", tokens(text))


def frequent_words(tok_docs: DataFrame, max_df: float = MAX_DF) -> DataFrame:
    """Stop words by rule: unigrams in at least ``max_df`` of a dataset's documents."""
    n_docs = tok_docs.groupBy("dataset").agg(F.count("*").alias("__n"))
    df = (tok_docs.select("dataset", F.explode(F.array_distinct("toks")).alias("word"))
          .groupBy("dataset", "word").agg(F.count("*").alias("__df")))
    return (df.join(per_dataset(n_docs), "dataset")
            .filter(F.col("__df") >= F.col("__n") * max_df).select("dataset", "word"))


def stop_lists(stop: DataFrame) -> tuple[DataFrame, bool]:
    """One row per dataset with its stop words as an array, and whether all of them are few enough to be sent
    to every task (``BROADCAST_WORDS``, counted on the written table)."""
    words = staged(stop.select("dataset", "word").distinct(), "stop-words")
    small = words.limit(BROADCAST_WORDS + 1).count() <= BROADCAST_WORDS
    return words.groupBy("dataset").agg(F.collect_set("word").alias("__stop")), small


def without_stop_words(tok_docs: DataFrame, stop: DataFrame | None) -> DataFrame:
    """``toks`` without stop words, in place: documents don't move. A dataset has at most (mean distinct words
    of a document) / ``max_df`` frequent words and those of its title. A document's own stop words are found by
    hashing; its words are then compared with these few."""
    if stop is None:
        return tok_docs
    lists, small = stop_lists(stop)
    if small:
        met = tok_docs.join(F.broadcast(lists), "dataset", "left")
    else:
        met = salted_join(tok_docs, lists, ["dataset"], spread_by=["commentId"], how="left")
    own = F.array_intersect("toks", F.coalesce("__stop", F.array().cast("array<string>")))
    # bound by a one-element transform: as a column it would be put into the filter and worked out for every word
    kept = F.transform(F.array(own), lambda o: F.filter("toks", lambda x: ~F.array_contains(o, x)))[0]
    return met.withColumn("toks", kept).drop("__stop")


#: Words of documents that are paired and counted at once in a task.
COUNTED_WORDS = 200_000


def counted(kept: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """(keys..., term, n, total) from rows of ``keys`` and ``toks``: unigrams and pairs of neighbours of each row,
    paired and counted by Arrow for many rows at a time. Documents don't move."""

    def block(b: pa.RecordBatch) -> pa.RecordBatch:
        t = pa.Table.from_batches([b])
        toks = t.column("toks").combine_chunks()
        size = pc.fill_null(pc.list_value_length(toks), 0).to_numpy()
        flat, row = toks.flatten(), np.repeat(np.arange(t.num_rows), size)
        first = np.flatnonzero(row[1:] == row[:-1])
        pairs = pc.binary_join_element_wise(flat.take(pa.array(first)), flat.take(pa.array(first + 1)), " ")
        terms = pa.table({"row": np.concatenate([row, row[first]]), "term": pa.chunked_array([flat, pairs], pa.string())})
        got = terms.group_by(["row", "term"]).aggregate([([], "count_all")]).combine_chunks()
        at = got.column("row").to_numpy()
        total = size + np.maximum(size - 1, 0)
        own = [t.column(k).take(pa.array(at)).combine_chunks() for k in keys]
        return pa.RecordBatch.from_arrays([*own, got.column("term").combine_chunks(), got.column("count_all").combine_chunks(),
                                           pa.array(total[at].astype(np.int64))], [*keys, "term", "n", "total"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size = pc.fill_null(pc.list_value_length(b.column(len(keys))), 0).to_numpy()
            part = np.cumsum(size) // COUNTED_WORDS
            cuts = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), b.num_rows] if b.num_rows else []
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                yield block(b.slice(lo, hi - lo))

    rows = kept.select(*keys, "toks")
    schema = StructType([*[rows.schema[k] for k in keys], StructField("term", StringType()), StructField("n", LongType()),
                         StructField("total", LongType())])
    return rows.mapInArrow(run, schema)


DOC_KEYS = ("dataset", "commentId", "topicId")


def doc_words(docs: DataFrame, stop: DataFrame | None = None, text: str = "commentText",
              keys: tuple[str, ...] = DOC_KEYS, max_df: float | None = None) -> DataFrame:
    """(keys..., toks): each document's words in order, without stop words. What ``doc_terms`` counts; as its pairs
    are neighbours, the words alone say all and are a small part of the terms' size when written."""
    rows = docs.select(*keys, tokens(text).alias("toks"))
    if max_df is not None:
        frequent = frequent_words(rows, max_df)
        stop = frequent if stop is None else frequent.unionByName(stop.select("dataset", "word"))
    return without_stop_words(rows, stop)


def doc_terms(docs: DataFrame, stop: DataFrame | None = None, text: str = "commentText",
              keys: tuple[str, ...] = DOC_KEYS, max_df: float | None = None) -> DataFrame:
    """H5: (keys..., term, n, total) counts of unigrams and bigrams per document; ``total`` is
    the document's number of terms.

    ``docs`` has one row per document. Stop words are removed before bigrams are built:
    ``stop`` (dataset, word) and, only if ``max_df`` is given, words of at least that share
    of a dataset's documents. Words are found inside the document's row, pairs and counts made where it is read:
    only the counts of ``frequent_words`` are shuffled, and no word with its document.
    """
    return counted(doc_words(docs, stop, text, keys, max_df), keys)


def topic_term_counts(dterms: DataFrame, topic: str = "topicId", sums: bool = False) -> DataFrame:
    """n(t, w) over documents of real topics (outliers, -1, excluded).

    From ``doc_words`` terms are counted by topic where the words are read and move packed (``packed``); with ``sums``
    each row then also has its term's count in all topics (``term_total``), and one row per term is marked (``term_first``),
    so that ``ctfidf`` moves nothing more. Rows of ``doc_terms`` are dealt by (dataset, term); a term has a row per
    document at most."""
    if "toks" in dterms.columns:
        n = P.buckets(dterms.sparkSession)
        return P.summed_counts(P.packed_counts(dterms.filter(F.col(topic) >= 0), topic, n), dterms.schema, topic, sums)
    return (dterms.filter(F.col(topic) >= 0).select("dataset", topic, "term", "n").repartition("dataset", "term")
            .groupBy("dataset", topic, "term").agg(F.sum("n").alias("n")))


def topic_totals(dterms: DataFrame, topic: str = "topicId") -> DataFrame:
    """tot(t): (dataset, topic, __tot), summed where the terms (or ``doc_words``) are read."""
    if "toks" in dterms.columns:
        n = F.size("toks")
        own = dterms.filter((F.col(topic) >= 0) & (n > 0)).select("dataset", topic, (2 * n - 1).cast("bigint").alias("n"))
        return own.groupBy("dataset", topic).agg(F.sum("n").alias("__tot"))
    return dterms.filter(F.col(topic) >= 0).groupBy("dataset", topic).agg(F.sum("n").alias("__tot"))


def ctfidf(tterms: DataFrame, topic: str = "topicId", totals: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """H7: returns (weights(dataset, topic, term, weight), idf(dataset, term, idf)).

    ``idf`` is kept separate so documents can be weighted with the same model
    (H11, H13). With ``totals`` (``topic_totals`` of all terms) ``tterms`` may hold the counts of some terms only, whose
    weights are those of the whole model."""
    tot = tterms.groupBy("dataset", topic).agg(F.sum("n").alias("__tot")) if totals is None else totals
    avg = tot.groupBy("dataset").agg(F.floor(F.avg("__tot")).alias("__A"))
    summed = "term_total" in tterms.columns  # counted with their sums: nothing moves
    if summed:
        f = tterms.filter("term_first").select("dataset", "term", F.col("term_total").alias("__f"))
    else:
        f = tterms.groupBy("dataset", "term").agg(F.sum("n").alias("__f"))
    idf = (f.join(per_dataset(avg), "dataset")
           .select("dataset", "term", F.ln(1 + F.col("__A") / F.col("__f")).alias("idf")))
    # a term's sum over topics beside its rows (one per topic), so that the long table joins no other long one
    found = F.col("term_total").alias("__f") if summed else F.sum("n").over(Window.partitionBy("dataset", "term")).alias("__f")
    w = (tterms.select("dataset", topic, "term", "n", found).join(per_topic(tot), ["dataset", topic]).join(per_dataset(avg), "dataset")
         .select("dataset", topic, "term",
                 (F.sqrt(F.col("n") / F.col("__tot")) * F.ln(1 + F.col("__A") / F.col("__f"))).alias("weight")))
    return w, idf


def top_terms(weights: DataFrame, k: int = 10, topic: str = "topicId") -> DataFrame:
    """H8: first ``k`` terms per topic by (weight desc, term), 1-based rank.
    ``row_number() <= k`` is limited per group before the shuffle."""
    w = Window.partitionBy("dataset", topic).orderBy(F.desc("weight"), "term")
    return weights.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def keyword_lists(top: DataFrame, topic: str = "topicId") -> DataFrame:
    """Representation column: ordered keyword array per topic (k items)."""
    return (top.groupBy("dataset", topic)
            .agg(F.sort_array(F.collect_list(F.struct("rank", "term"))).alias("__k"))
            .select("dataset", topic, F.col("__k.term").alias("Representation")))


def doc_weights(dterms: DataFrame, idf: DataFrame) -> DataFrame:
    """Per-document c-TF-IDF vector d(w) = sqrt(n(d,w)/total(d)) * idf(w)."""
    # no count of hot terms, which would move all rows once more: a term meets one row, so a frequent one only streams
    return (dterms.join(idf, ["dataset", "term"])
            .withColumn("dweight", F.sqrt(F.col("n") / F.col("total")) * F.col("idf")).drop("total", "idf"))


def doc_weights_of(dterms: DataFrame, docs: DataFrame, topic: str = "topicId") -> DataFrame:
    """``doc_weights`` of the documents in ``docs`` (dataset, commentId) under the model of all documents.

    The model is asked only for these documents' terms, so the terms of the others are read, not shuffled. What is
    sent to every task is counted first (``skew.few``)."""
    ids = staged(docs.select("dataset", "commentId").distinct(), "weighed-docs")
    own = staged(dterms.join(few(ids), ["dataset", "commentId"], "left_semi"), "weighed-terms")
    terms = staged(own.select("dataset", "term").distinct(), "terms-asked")
    asked = dterms.join(few(terms), ["dataset", "term"], "left_semi")
    return doc_weights(own, ctfidf(topic_term_counts(asked, topic), topic, topic_totals(dterms, topic))[1])


def representative_docs(dterms: DataFrame, weights: DataFrame, idf: DataFrame, k: int = 3,
                        topic: str = "topicId") -> DataFrame:
    """The ``k`` documents of each topic closest (cosine) to the topic's
    c-TF-IDF vector; ties by commentId.

    Documents stay in blocks, whose distinct terms ask for their weights (``termblocks``); a document's product with
    its own topic and its norm are summed in its block. ``dterms`` are ``doc_terms`` or ``doc_words``."""
    tnorm = weights.groupBy("dataset", topic).agg(F.sqrt(F.sum(F.col("weight") ** 2)).alias("__tn"))
    kind = {c: dterms.schema[c].dataType for c in ("commentId", topic)}
    blocks = counted_blocks(dterms.filter(F.col(topic) >= 0), topic)
    scored = (scores(blocks, term_model(weights, idf, topic), own_topic_scores, topic, squares=True)
              .select("dataset", F.col(topic).cast(kind[topic]).alias(topic), F.col("commentId").cast(kind["commentId"]).alias("commentId"),
                      F.col("score").alias("__dot"), F.sqrt("square").alias("__dn"))
              .join(per_topic(tnorm), ["dataset", topic])
              .withColumn("score", F.col("__dot") / (F.col("__dn") * F.col("__tn"))))
    # exact copies score equal up to summation order; compare at 1e-9 so the
    # id tie-break decides
    w = Window.partitionBy("dataset", topic).orderBy(F.desc(F.round("score", 9)), "commentId")
    return (scored.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select("dataset", topic, "commentId", "rank", F.round("score", 6).alias("score")))


def reassign_by_terms(assign: DataFrame, dterms: DataFrame, weights: DataFrame, idf: DataFrame,
                      topic: str = "topicId") -> DataFrame:
    """Rows still -1 take the topic with the largest sum of
    d(w) * weight(t, w) over shared terms if it is > 0 (d(w) as in ``doc_weights``); else they stay -1. One
    window, the whole text; ``reassign_by_distributions`` has overlapping ones.

    ``dterms`` holds the terms (or ``doc_words``) of ``assign``'s rows under their topic. The outliers' terms meet the topics by blocks
    of documents (``termblocks``), so no row is made per document, term and topic."""
    out = assign.filter(F.col(topic) == -1).select("dataset", "commentId").distinct()
    sums = scores(counted_blocks(dterms.filter((F.col(topic) == -1) & F.col("commentId").isNotNull())), term_model(weights, idf, topic), whole_text_scores, "__t")
    best = (sums.filter("score > 0").groupBy("dataset", "commentId")
            .agg(F.max_by("__t", F.struct(F.col("score"), -F.col("__t"))).alias("__best"))
            .join(out, ["dataset", "commentId"], "left_semi"))
    return (assign.join(best, ["dataset", "commentId"], "left")
            .withColumn(topic, F.when(F.col(topic) == -1, F.coalesce("__best", F.lit(-1)))
                        .otherwise(F.col(topic)).cast("int"))
            .drop("__best"))


def kept_words(docs: DataFrame, stop: DataFrame | None, text: str = "commentText") -> DataFrame:
    """(dataset, commentId, words): each document's words in order, without stop words; documents
    without any are left out. ``docs`` hold texts or, as ``doc_words``, words."""
    rows = docs.select("dataset", "commentId", "toks" if "toks" in docs.columns else tokens(text).alias("toks"))
    return without_stop_words(rows, stop).filter(F.size("toks") > 0).withColumnRenamed("toks", "words")


def topic_distributions(docs: DataFrame, stop: DataFrame | None, weights: DataFrame, idf: DataFrame, size: int = 4, stride: int = 1,
                        min_similarity: float = 0.1, topic: str = "topicId") -> DataFrame:
    """(dataset, commentId, topic, score): per document and topic the sum over its windows of the cosine
    between the window's and the topic's c-TF-IDF vectors, windows under ``min_similarity`` left out.

    Windows are formed, weighed and multiplied in their block of documents (``termblocks``); only a block's distinct
    terms meet the model, never a window's."""
    blocks = word_blocks(kept_words(docs, stop))
    return scores(blocks, term_model(weights, idf, topic, unit=True), window_scores(size, stride, min_similarity), topic)


def reassign_by_distributions(assign: DataFrame, docs: DataFrame, stop: DataFrame | None, weights: DataFrame, idf: DataFrame,
                              size: int = 4, stride: int = 1, min_similarity: float = 0.1, topic: str = "topicId") -> DataFrame:
    """Rows still -1 take the topic with the largest score of ``topic_distributions`` (equal at 1e-9:
    the lower id); rows without a window that resembles a topic stay -1. ``docs`` hold texts or ``doc_words``."""
    left = staged(assign.filter(F.col(topic) == -1).select("dataset", "commentId"), "outliers")
    out = docs.select("dataset", "commentId", "toks" if "toks" in docs.columns else "commentText").join(few(left), ["dataset", "commentId"], "left_semi")
    best = (topic_distributions(out, stop, weights, idf, size, stride, min_similarity, topic).groupBy("dataset", "commentId")
            .agg(F.max_by(topic, F.struct(F.round("score", 9), -F.col(topic))).alias("__best")))
    return (assign.join(best, ["dataset", "commentId"], "left")
            .withColumn(topic, F.when(F.col(topic) == -1, F.coalesce("__best", F.lit(-1))).otherwise(F.col(topic)).cast("int")).drop("__best"))
