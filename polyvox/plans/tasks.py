"""Task registry (M4): the seven tasks of the pipeline as Spark jobs.

``run(spark, ["ingest", "moderate", ...], ctx)`` runs the named tasks in
order for every dataset at once; each task reads the tables the previous
ones wrote (parquet, partitioned by dataset) and writes its own. A failing
task is reported and the next one still runs, as in the reference's CLI.
"""

from __future__ import annotations

import logging
import traceback
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from polyvox import schemas
from polyvox.operators import maprender as AM
from polyvox.operators import arguments as AR
from polyvox.operators import cluster as K
from polyvox.operators import hierarchy as HI
from polyvox.operators import edges as E
from polyvox.operators import embed as EM
from polyvox.operators import moderation as MO
from polyvox.operators import scoring as S
from polyvox.operators import select as C
from polyvox.operators import text as T
from polyvox.operators import topics as TP
from polyvox.sources import io

log = logging.getLogger("polyvox.tasks")


@dataclass
class Context:
    raw_root: str                    # {raw_root}/{dataset}/{table}.csv
    data_root: str                   # parquet tables, partitioned by dataset
    datasets: list[str] | None = None
    options: dict = field(default_factory=dict)


def _ckpt(df):
    return K._ckpt(df)


def _read(spark, ctx, name):
    return io.read_table(spark, ctx.data_root, name, datasets=ctx.datasets)


def _write(spark, ctx, df, name, worked=None, add=False):
    """One commit (A6, G1): replaces what ``worked`` (by default every ingested dataset of the run) had in the
    table, or adds. ``options["run"]`` names the run; repeating a run leaves its committed tables as they are."""
    run = f"{ctx.options['run']}-{name}" if ctx.options.get("run") else None
    if add:
        return io.append_table(df, ctx.data_root, name, run=run)
    worked = _read(spark, ctx, "summary").select("dataset").distinct() if worked is None else worked
    return io.write_table(df, ctx.data_root, name, worked, run)


def _raw(spark, ctx, name):
    return spark.createDataFrame([(d,) for d in io.raw_datasets(spark, ctx.raw_root, name, ctx.datasets)], "dataset string")


def ingest(spark: SparkSession, ctx: Context) -> None:
    """Summary + comments (A1, A2, A3, A11) + embeddings (H1) + votes (A4)."""
    _write(spark, ctx, io.read_summary(spark, ctx.raw_root, ctx.datasets), "summary", _raw(spark, ctx, "summary"))
    comments = _ckpt(io.load_comments(spark, ctx.data_root, ctx.raw_root, ctx.datasets))
    emb = EM.hash_embeddings(comments).select("dataset", "commentId", "embedding")
    _write(spark, ctx, comments.join(emb, ["dataset", "commentId"], "left"), "comments", _raw(spark, ctx, "comments"))
    _write(spark, ctx, io.read_votes(spark, ctx.raw_root, ctx.datasets), "votes", _raw(spark, ctx, "votes"))


def moderate(spark: SparkSession, ctx: Context) -> None:
    """Every config of the task's grid (or of ``configs``) in one job."""
    comments = _read(spark, ctx, "comments")
    grid = MO.config_table(spark, ctx.options.get("configs") or MO.task_grid())
    feats = _ckpt(MO.text_features(comments))  # worked out once, not once per config
    _write(spark, ctx, MO.classify(feats, grid).drop("moderated"), "moderationResults")


def topic_model(spark: SparkSession, ctx: Context) -> None:
    """H3 -> H4 -> H12 -> H5-H8, H11 -> H13 -> J6 -> H10, H15, H20."""
    comments = _read(spark, ctx, "comments")
    summary = _read(spark, ctx, "summary")
    docs = C.not_rejected(comments)
    # each stage's output is checkpointed in the shared folder: lineage stays
    # short, plans stay small and a lost executor re-reads, not recomputes
    assign = _ckpt(K.kmeans_topics(docs.select("dataset", "commentId", "embedding"),
                                   outlier_distance=ctx.options.get("outlier_distance"),
                                   link_distance=ctx.options.get("link_distance")))
    assign = assign.join(docs.select("dataset", "commentId", "embedding"), ["dataset", "commentId"])
    # H4: near-equal topics become one before outliers are dealt out
    assign = _ckpt(K.reduce_topics(assign, K.centroids(assign), ctx.options.get("merge_similarity", 0.9)))
    assign = _ckpt(K.reassign_by_embedding(assign, K.centroids(assign)).drop("similarity", "embedding"))
    text = docs.select("dataset", "commentId", "commentText").join(assign, ["dataset", "commentId"])
    stop = T.title_stop_words(summary)
    dterms = _ckpt(T.doc_terms(text, stop))
    weights, idf = T.ctfidf(T.topic_term_counts(dterms))
    assign = _ckpt(T.reassign_by_distributions(assign, docs, stop, weights, idf))
    # Keywords of the final assignment
    dterms = _ckpt(T.doc_terms(text.drop("topicId").join(assign, ["dataset", "commentId"]), stop))
    weights, idf = T.ctfidf(T.topic_term_counts(dterms))
    kw = T.top_terms(weights, 10)
    rep = T.representative_docs(dterms, weights, idf, 3)
    labels = TP.headings(kw, stop, topics=assign)
    info = TP.topic_info(K.topic_sizes(assign), kw, rep, comments, labels)
    _write(spark, ctx, info, "topics")
    _write(spark, ctx, HI.hierarchy(weights), "hierarchicalTopics")
    _write(spark, ctx, TP.replace_columns(comments, assign, ["dataset", "commentId"], ["topicId"]), "comments_topics")


def _left(spark, ctx: Context, todo, table: str, keys: list[str]):
    """What a resumed run still has to do, and whether its rows are then added (G1)."""
    if ctx.options.get("resume") and io.exists(spark, io.table_path(ctx.data_root, table)):
        return AR.pending(todo, io.read_table(spark, ctx.data_root, table), keys), True
    return todo, False


def generate(spark: SparkSession, ctx: Context) -> None:
    """J7 over agreeable statements (C4). With ``resume``, topics that have arguments are
    left as they are and only the others are added (J11)."""
    comments = _read(spark, ctx, "comments_topics")
    summary = _read(spark, ctx, "summary")
    agreeable = C.agreeable_comments(comments.filter(F.col("topicId") >= 0))
    dterms = T.doc_terms(agreeable, T.title_stop_words(summary))
    weights, idf = T.ctfidf(T.topic_term_counts(dterms))
    todo, add = _left(spark, ctx, agreeable, "arguments", ["dataset", "topicId"])
    args = AR.generate_arguments(todo, T.doc_weights(dterms, idf))
    args = args.withColumn("thoughts", F.split("thoughts", r" \| "))
    _write(spark, ctx, io.cast_to(args, schemas.ARGUMENTS), "arguments", add=add)


def correlate(spark: SparkSession, ctx: Context) -> None:
    """D7 + J9 over agreeable statements x arguments of their topic. Without a pair nothing
    is written (C15); with ``resume`` only topics without edges are worked (J11)."""
    comments = _read(spark, ctx, "comments_topics")
    args = _read(spark, ctx, "arguments")
    agreeable = C.agreeable_comments(comments.filter(F.col("topicId") >= 0))
    todo, add = _left(spark, ctx, agreeable, "argumentCommentMap", ["dataset", "topicId"])
    if E.pair_count(todo, args).filter("pairs > 0").isEmpty():
        log.info("no statement/argument pairs")
        return
    edges = AR.correlate(todo, args)
    edges = edges.withColumn("reasoning", F.array_compact(F.array("reasoning"))).drop("score")
    _write(spark, ctx, edges, "argumentCommentMap", add=add)


def score(spark: SparkSession, ctx: Context) -> None:
    """K1."""
    topics = _read(spark, ctx, "topics")
    ats = S.score(topics, _read(spark, ctx, "arguments"), _read(spark, ctx, "argumentCommentMap"),
                  _read(spark, ctx, "votes"))
    _write(spark, ctx, ats, "argumentTopicSupport")


def render(spark: SparkSession, ctx: Context) -> None:
    """K2 + K3 written as text (A14), one folder per dataset."""
    summary = _read(spark, ctx, "summary")
    topics = _read(spark, ctx, "topics")
    edges = _read(spark, ctx, "argumentCommentMap")
    comments = _read(spark, ctx, "comments")
    ats = _read(spark, ctx, "argumentTopicSupport")
    AM.write_maps(AM.top_map(summary, topics, edges, comments, ats),
                  f"{ctx.data_root}/maps/arguments-top")
    AM.write_maps(AM.all_map(summary, topics, _read(spark, ctx, "arguments"), edges, comments, ats),
                  f"{ctx.data_root}/maps/arguments-all")


TASKS: dict[str, Callable[[SparkSession, Context], None]] = {
    "ingest": ingest, "moderate": moderate, "topicModel": topic_model, "generate": generate,
    "correlate": correlate, "score": score, "render": render,
}


def run(spark: SparkSession, names: list[str], ctx: Context) -> dict[str, str]:
    """Run tasks in order; returns {task: "ok" | error text}."""
    status = {}
    for name in names:
        try:
            TASKS[name](spark, ctx)
            status[name] = "ok"
        except Exception as e:  # noqa: BLE001 - report and go on, like the reference CLI
            log.error("task %s failed: %s", name, traceback.format_exc())
            status[name] = f"{type(e).__name__}: {e}"
    return status
