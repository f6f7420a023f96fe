"""Argument generation and argument/statement correlation.

The reference asks a chat model to write arguments per topic and to label
every (statement, argument) pair of a topic. Here both are distributed
jobs with deterministic default scorers written as column expressions:

* generation is extractive: a topic's budget of ceil(2 ln n) arguments are
  its most agreeable statements, titled by their top c-TF-IDF terms;
* correlation labels each pair from the overlap of their word sets.

Model-backed scorers plug in with ``score_pairs_with`` (``mapInPandas``).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from polyvox.functions.exprs import argument_budget, first_sentence, percent_agree, tokens
from polyvox.operators.rank import running
from polyvox.operators.skew import per_topic, topic_join

MAX_BUDGET = 64          # ceil(2 ln n) <= 64 for n < 7.9e13 statements per topic
SUPPORT_OVERLAP = 0.6    # overlap coefficient at or above which a pair is related
# ---- fixed values (ours): negation words of the four fixture languages ----
NEGATIONS = ["not", "no", "never", "none", "nothing", "nicht", "kein", "keine", "nie",
             "pas", "jamais", "non", "nunca", "nada", "ni"]
# ---------------------------------------------------------------------------


def statement_lines(agreeable: DataFrame) -> DataFrame:
    """J8 + I5: one prompt line per statement, ``{id}. {text} ({pct}% voters
    agree)``, percent truncated, ``n/a`` without votes. Long form: a topic's
    prompt is its lines in (agreeability desc, commentId) order."""
    pct = F.coalesce(percent_agree().cast("string"), F.lit("n/a"))
    return agreeable.select(
        "dataset", "topicId", "commentId",
        F.concat(F.col("commentId").cast("string"), F.lit(". "), F.col("commentText"),
                 F.lit(" ("), pct, F.lit("% voters agree)")).alias("line"))


def argument_sources(agreeable: DataFrame) -> DataFrame:
    """(dataset, topicId, commentId, commentText, __rk, __n): the statements that ``generate_arguments`` writes from."""
    n = agreeable.groupBy("dataset", "topicId").agg(F.count("*").alias("__n"))
    w = Window.partitionBy("dataset", "topicId").orderBy(
        F.desc("agreeability"), F.desc("agrees"), "commentId")
    return (agreeable.select("dataset", "topicId", "commentId", "commentText",
                             F.row_number().over(w).alias("__rk"))
            .filter(F.col("__rk") <= MAX_BUDGET)
            .join(per_topic(n), ["dataset", "topicId"])
            .filter(F.col("__rk") <= argument_budget("__n")))


def generate_arguments(agreeable: DataFrame, doc_weights: DataFrame, n_title_terms: int = 3) -> DataFrame:
    """J7 (extractive default): per topic, the ceil(2 ln n) statements with the
    highest (agreeability, agrees), lowest id on ties, become arguments
    0..K-1. Title = the statement's ``n_title_terms`` best c-TF-IDF terms;
    content = its first whole sentence; thoughts = AREA / PROBLEMS strings.

    The rank window is cut to MAX_BUDGET rows per topic before the shuffle,
    which is exact for any realistic topic size."""
    picked = argument_sources(agreeable)
    tw = Window.partitionBy("dataset", "commentId").orderBy(
        F.desc(F.round("dweight", 9)), "term")
    terms = (doc_weights.join(picked.select("dataset", "commentId"), ["dataset", "commentId"],
                              "left_semi")
             .withColumn("__tr", F.row_number().over(tw)).filter(F.col("__tr") <= n_title_terms)
             .groupBy("dataset", "commentId")
             .agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("__tr", "term"))),
                                           lambda x: x["term"]), " ").alias("__title")))
    out = picked.join(terms, ["dataset", "commentId"], "left")
    title = F.coalesce(F.col("__title"), F.lit(""))
    content = first_sentence("commentText")
    return out.select(
        "dataset", "topicId", (F.col("__rk") - 1).cast("bigint").alias("argumentId"),
        title.alias("argumentTitle"), content.alias("argumentContent"),
        F.concat_ws(" | ", F.concat(F.lit("AREA: "), title),
                    F.concat(F.lit("PROBLEMS: "), content)).alias("thoughts"),
        F.col("commentId").alias("sourceCommentId"))


def correlate(statements: DataFrame, arguments: DataFrame,
              threshold: float = SUPPORT_OVERLAP) -> DataFrame:
    """J9 (overlap default) over the D7 pair table, rows independent.

    score = |words(s) & words(a)| / min(|words(s)|, |words(a)|);
    score >= threshold -> SUPPORT, or REFUTE when exactly one side has a
    negation word; else UNRELATED. A reason only for related pairs."""
    s = statements.select("dataset", "topicId", "commentId",
                          F.array_distinct(tokens("commentText")).alias("__ws"))
    a = arguments.select("dataset", "topicId", "argumentId",
                         F.array_distinct(tokens("argumentContent")).alias("__wa"))
    pairs = topic_join(s, a)
    neg = F.array(*[F.lit(x) for x in NEGATIONS])
    inter = F.size(F.array_intersect("__ws", "__wa"))
    smaller = F.least(F.size("__ws"), F.size("__wa"))
    score = F.try_divide(inter.cast("double"), smaller.cast("double"))
    related = F.coalesce(score >= threshold, F.lit(False))
    flip = F.arrays_overlap("__ws", neg) != F.arrays_overlap("__wa", neg)
    rel = (F.when(related & flip, "REFUTE").when(related, "SUPPORT").otherwise("UNRELATED"))
    return pairs.select(
        "dataset", "commentId", "topicId", "argumentId", rel.alias("relationship"),
        F.round(score, 6).alias("score"),
        F.when(related, F.concat(F.lit("REASON: shares "), inter.cast("string"), F.lit(" of "),
                                 smaller.cast("string"), F.lit(" words"))).alias("reasoning"))


def argument_prompts(agreeable: DataFrame, summary: DataFrame, context: int = 50) -> DataFrame:
    """J7 input for a model: per topic all its agreeable statements, best first, in prompts
    of up to ``context`` statements (what fits a model's context; a parameter) numbered by
    ``part`` from 0; each names the whole topic's budget of areas. Wording ours."""
    n = agreeable.groupBy("dataset", "topicId").agg(F.count("*").alias("__n"))
    best = [F.desc("agreeability"), F.desc("agrees"), "commentId"]
    ranked = running(agreeable.select("dataset", "topicId", "commentId", "agreeability", "agrees"), ["dataset", "topicId"], best, "__rk")
    lines = (ranked.select("dataset", "topicId", "commentId", "__rk", F.floor((F.col("__rk") - 1) / context).cast("int").alias("part"))
             .join(statement_lines(agreeable), ["dataset", "topicId", "commentId"])
             .groupBy("dataset", "topicId", "part").agg(F.array_join(F.transform(
                 F.sort_array(F.collect_list(F.struct("__rk", "line"))), lambda x: x["line"]), "\n").alias("__lines")))
    title = summary.filter(F.col("key") == "topic").select("dataset", F.col("value").alias("__title"))
    return (lines.join(per_topic(n), ["dataset", "topicId"]).join(title, "dataset", "left")
            .select("dataset", "topicId", "part", F.concat(
                F.lit("Topic: "), F.coalesce("__title", F.lit("")), F.lit("\nName "), argument_budget("__n").cast("string"),
                F.lit(" areas of concern. For each write:\nAREA:\nPROBLEMS:\nSOLUTIONS:\nARGUMENT: one sentence\nTITLE: three words\n\n"),
                F.col("__lines")).alias("prompt")))


def pair_prompts(statements: DataFrame, arguments: DataFrame) -> DataFrame:
    """J9 input for a model: one prompt per pair of a topic (see ``score_pairs_with``). Wording ours."""
    s = statements.select("dataset", "topicId", "commentId", "commentText")
    a = arguments.select("dataset", "topicId", "argumentId", "argumentTitle", "argumentContent")
    return (topic_join(s, a)
            .select("dataset", "topicId", "argumentId", "commentId", F.concat(
                F.lit("ARGUMENT: "), F.col("argumentTitle"), F.lit(". "), F.col("argumentContent"),
                F.lit("\nCOMMENT: "), F.col("commentText"),
                F.lit("\nTHOUGHT: how they relate\nRELATIONSHIP: SUPPORT, REFUTE or UNRELATED\nREASON: unless unrelated\n"))
                .alias("prompt")))


def score_pairs_with(pairs: DataFrame, scorer: Callable[[pd.DataFrame], pd.DataFrame],
                     schema: str, partitions: int | None = None) -> DataFrame:
    """M2 for J9: a model-backed pair scorer over Arrow batches. Pairs are
    hash-repartitioned first so a large topic's pairs spread evenly."""
    n = partitions or pairs.sparkSession.sparkContext.defaultParallelism
    spread = pairs.repartition(n, F.xxhash64("dataset", "commentId", "argumentId"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield scorer(b)
    return spread.mapInPandas(run, schema)


def pending(todo: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """The part of ``todo`` whose keys are not yet in ``done`` (resume
    after a failure: write results per partition, recompute only the rest)."""
    return todo.join(done.select(*keys).distinct(), keys, "left_anti")
