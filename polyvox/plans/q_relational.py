"""Relational queries: votes, scoring, selection, edges, reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from polyvox.operators import edges as E
from polyvox.operators import reports as R
from polyvox.operators import scoring as S
from polyvox.operators import select as C
from polyvox.operators.votes import comment_tally, latest_vote
from polyvox.plans.catalog import query
from polyvox.sources.adapters import VOTE_ORDER, Fixture


def fx(spark, sf_dir) -> Fixture:
    return Fixture(spark, sf_dir)


@query("latest_vote", "C1 E1", """
SELECT * FROM fx_votes""")
def q_latest_vote(spark, sf_dir):
    return latest_vote(fx(spark, sf_dir).votes_raw, VOTE_ORDER)


@query("latest_vote_events", "C1 E1 (re-vote heavy log)", """
SELECT dataset, commentId, voterId, vote, ts AS timestamp FROM (
  SELECT *, row_number() OVER (PARTITION BY dataset, commentId, voterId
                               ORDER BY ts DESC, event_id DESC) AS rn
  FROM fx_votes_events WHERE vote <> 0) WHERE rn = 1""")
def q_latest_vote_events(spark, sf_dir):
    return latest_vote(fx(spark, sf_dir).votes_events, ["ts", "event_id"])


@query("comment_tally", "E1 I1", """
SELECT dataset, commentId, agrees, disagrees,
       CASE WHEN agrees + disagrees = 0 THEN CAST(0 AS DOUBLE)
            ELSE agrees / (agrees + disagrees) END AS agreeability
FROM fx_tally""")
def q_comment_tally(spark, sf_dir):
    return comment_tally(fx(spark, sf_dir).votes)


@query("voter_net_vote", "C9 D3 E2 I3 I4", """
SELECT m.dataset, m.topicId, m.argumentId, v.voterId,
       CAST(sign(sum(v.vote)) AS INTEGER) AS vote,
       sum(v.vote) > 0 AS agree, sum(v.vote) < 0 AS disagree
FROM fx_map m JOIN fx_votes v ON m.dataset = v.dataset AND m.commentId = v.commentId
WHERE m.relationship = 'SUPPORT'
GROUP BY m.dataset, m.topicId, m.argumentId, v.voterId""")
def q_voter_net_vote(spark, sf_dir):
    f = fx(spark, sf_dir)
    return S.voter_net_vote(f.edges, f.votes)


@query("argument_support", "E3 I2", "SELECT * FROM fx_support")
def q_argument_support(spark, sf_dir):
    f = fx(spark, sf_dir)
    return S.argument_support(S.voter_net_vote(f.edges, f.votes))


@query("argument_topic_support", "K1 (C9 D3 E2 E3 D4 D5)", "SELECT * FROM fx_ats")
def q_argument_topic_support(spark, sf_dir):
    f = fx(spark, sf_dir)
    return S.score(f.topics, f.arguments, f.edges, f.votes)


@query("top_arguments_per_topic", "F1", """
SELECT dataset, topicId, argumentId, argumentTitle, agreeability, agrees, disagrees, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY dataset, topicId
                               ORDER BY agreeability DESC NULLS LAST, argumentId) AS rank
  FROM fx_ats) WHERE rank <= 3""")
def q_top_arguments(spark, sf_dir):
    f = fx(spark, sf_dir)
    return S.top_arguments(S.score(f.topics, f.arguments, f.edges, f.votes), 3).select(
        "dataset", "topicId", "argumentId", "argumentTitle", "agreeability", "agrees",
        "disagrees", "rank")


@query("strongest_arguments", "F3 K5", """
SELECT dataset, topicId, topicTitle, argumentId, argumentTitle, support, agrees, disagrees,
       agreeability, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY dataset, topicId
                               ORDER BY agreeability DESC NULLS LAST, argumentId) AS rank
  FROM fx_ats) WHERE rank <= 2""")
def q_strongest(spark, sf_dir):
    f = fx(spark, sf_dir)
    return S.ranked(S.strongest_arguments(S.score(f.topics, f.arguments, f.edges, f.votes), 2))


@query("top_comments_per_argument", "D8 F2", """
WITH top AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY dataset, topicId
                 ORDER BY agreeability DESC NULLS LAST, argumentId) AS rank FROM fx_ats)
  WHERE rank <= 3),
j AS (
  SELECT t.dataset, t.topicId, t.argumentId, t.argumentTitle, m.commentId,
         c.commentText, c.agrees, c.disagrees,
         CAST(c.agrees AS DOUBLE) / nullif(c.agrees + c.disagrees, 0) AS agreeability
  FROM top t
  LEFT JOIN (SELECT * FROM fx_map WHERE relationship = 'SUPPORT') m
    ON t.dataset = m.dataset AND t.topicId = m.topicId AND t.argumentId = m.argumentId
  LEFT JOIN fx_comments c ON m.dataset = c.dataset AND m.commentId = c.commentId)
SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY dataset, topicId, argumentId
                               ORDER BY agrees DESC NULLS LAST, commentId) AS commentRank
  FROM j) WHERE commentRank <= 3""")
def q_top_comments(spark, sf_dir):
    f = fx(spark, sf_dir)
    top = S.top_arguments(S.score(f.topics, f.arguments, f.edges, f.votes), 3)
    return S.top_comments(top, f.edges, f.comments, 3)


_COMMENT_COLS = ("dataset, commentId, authorId, timestamp, commentText, moderated, topicId, "
                 "agrees, disagrees, agreeability")
_COMMENT_LIST = [c.strip() for c in _COMMENT_COLS.split(",")]


@query("agreeable_comments_global", "C4 E13", f"""
SELECT {_COMMENT_COLS} FROM fx_comments c
JOIN (SELECT dataset, quantile_cont(agreeability, 0.1) AS t FROM fx_comments
      WHERE moderated = 1 GROUP BY dataset) q USING (dataset)
WHERE moderated = 1 AND agreeability >= t""")
def q_agreeable_global(spark, sf_dir):
    return C.agreeable_comments(fx(spark, sf_dir).comments, quantile=0.1).select(*_COMMENT_LIST)


@query("agreeable_comments_per_topic", "C5 E13", f"""
SELECT {_COMMENT_COLS} FROM fx_comments c
JOIN (SELECT dataset, topicId, quantile_cont(agreeability, 0.5) AS t FROM fx_comments
      WHERE moderated = 1 GROUP BY dataset, topicId) q USING (dataset, topicId)
WHERE moderated = 1 AND agreeability >= t""")
def q_agreeable_topic(spark, sf_dir):
    return C.topic_comments(fx(spark, sf_dir).comments, quantile=0.5).select(*_COMMENT_LIST)


@query("agreeable_best_first", "C6 F8", f"""
SELECT {_COMMENT_COLS} FROM fx_comments
WHERE moderated = 1 AND agreeability > 0.5
ORDER BY dataset, topicId, agreeability DESC, commentId""")
def q_best_first(spark, sf_dir):
    return C.best_first(fx(spark, sf_dir).comments, 0.5).select(*_COMMENT_LIST)


@query("argument_budget", "E4 E9 I6", """
WITH a AS (SELECT c.* FROM fx_comments c
           JOIN (SELECT dataset, quantile_cont(agreeability, 0.1) AS t FROM fx_comments
                 WHERE moderated = 1 GROUP BY dataset) q USING (dataset)
           WHERE moderated = 1 AND agreeability >= t),
n AS (SELECT dataset, topicId, count(*) AS n FROM a GROUP BY dataset, topicId)
SELECT dataset, topicId, n,
       CAST(CASE WHEN n <= 1 THEN 0 ELSE ceil(ln(n) * 2) END AS INTEGER) AS budget,
       CAST(sum(CAST(CASE WHEN n <= 1 THEN 0 ELSE ceil(ln(n) * 2) END AS INTEGER))
            OVER (PARTITION BY dataset) AS BIGINT) AS total_budget
FROM n""")
def q_budget(spark, sf_dir):
    return C.budget_per_topic(C.agreeable_comments(fx(spark, sf_dir).comments, quantile=0.1))


@query("pair_count", "D6 E8", """
SELECT s.dataset, CAST(sum(s.n * a.n) AS BIGINT) AS pairs
FROM (SELECT dataset, topicId, count(*) AS n FROM fx_comments WHERE moderated = 1
      GROUP BY dataset, topicId) s
JOIN (SELECT dataset, topicId, count(*) AS n FROM fx_arguments GROUP BY dataset, topicId) a
  ON s.dataset = a.dataset AND s.topicId = a.topicId
GROUP BY s.dataset""")
def q_pair_count(spark, sf_dir):
    f = fx(spark, sf_dir)
    return E.pair_count(C.accepted(f.comments), f.arguments)


@query("topic_pairs", "D7", """
SELECT c.dataset, c.topicId, c.commentId, a.argumentId
FROM fx_comments c JOIN fx_arguments a ON c.dataset = a.dataset AND c.topicId = a.topicId
WHERE c.moderated = 1""")
def q_topic_pairs(spark, sf_dir):
    f = fx(spark, sf_dir)
    return E.topic_pairs(C.accepted(f.comments), f.arguments).select(
        "dataset", "topicId", "commentId", "argumentId")


@query("relationship_counts", "E5", """
SELECT dataset, relationship, count(*) AS count FROM fx_map GROUP BY dataset, relationship""")
def q_relationship_counts(spark, sf_dir):
    return E.relationship_counts(fx(spark, sf_dir).edges)


@query("edges_by_topic_argument", "C10 E6", """
SELECT dataset, topicId, argumentId, relationship, count(commentId) AS count
FROM fx_map WHERE relationship <> 'UNRELATED'
GROUP BY dataset, topicId, argumentId, relationship""")
def q_edges_by_topic_argument(spark, sf_dir):
    return E.edges_by_topic_argument(fx(spark, sf_dir).edges)


@query("edges_topic_histogram", "C10 E7", """
SELECT dataset, topicId, count_if(relationship = 'SUPPORT') AS SUPPORT,
       count_if(relationship = 'REFUTE') AS REFUTE
FROM fx_map WHERE relationship <> 'UNRELATED' GROUP BY dataset, topicId""")
def q_edges_topic_histogram(spark, sf_dir):
    return E.edges_topic_histogram(fx(spark, sf_dir).edges)


@query("refute_samples", "C11 D11 E12 K4", """
WITH f AS (
  SELECT dataset, topicId, min({'commentId': commentId, 'argumentId': argumentId}) AS k
  FROM fx_map WHERE relationship = 'REFUTE' GROUP BY dataset, topicId)
SELECT f.dataset, f.topicId, f.k.commentId AS commentId, f.k.argumentId AS argumentId,
       a.argumentTitle, c.commentText, c.agrees, c.disagrees, t.Title AS topicTitle
FROM f
LEFT JOIN fx_arguments a ON f.dataset = a.dataset AND f.topicId = a.topicId
                         AND f.k.argumentId = a.argumentId
LEFT JOIN fx_comments c ON f.dataset = c.dataset AND f.k.commentId = c.commentId
LEFT JOIN fx_topics t ON f.dataset = t.dataset AND f.topicId = t.Topic""")
def q_refute_samples(spark, sf_dir):
    f = fx(spark, sf_dir)
    return S.refute_samples(f.edges, f.arguments, f.comments, f.topics).select(
        "dataset", "topicId", "commentId", "argumentId", "argumentTitle", "commentText",
        "agrees", "disagrees", "topicTitle")


@query("comments_per_argument", "E11 D10", """
WITH s AS (SELECT dataset, topicId, argumentId, commentId FROM fx_map
           WHERE relationship = 'SUPPORT')
SELECT s.dataset, s.topicId, s.argumentId, s.commentId, a.argumentTitle, n.n_comments
FROM s
LEFT JOIN fx_arguments a ON s.dataset = a.dataset AND s.topicId = a.topicId
                         AND s.argumentId = a.argumentId
JOIN (SELECT dataset, topicId, argumentId, count(*) AS n_comments FROM s
      GROUP BY dataset, topicId, argumentId) n
  ON s.dataset = n.dataset AND s.topicId = n.topicId AND s.argumentId = n.argumentId""")
def q_comments_per_argument(spark, sf_dir):
    f = fx(spark, sf_dir)
    return E.comments_per_argument(f.edges, f.arguments).select(
        "dataset", "topicId", "argumentId", "commentId", "argumentTitle", "n_comments")


@query("supporting_comments", "E15 D9", """
SELECT s.dataset, s.commentId, c.commentText, c.agrees, c.disagrees, c.agreeability
FROM (SELECT DISTINCT dataset, commentId FROM fx_map WHERE relationship = 'SUPPORT') s
LEFT JOIN fx_comments c ON s.dataset = c.dataset AND s.commentId = c.commentId""")
def q_supporting_comments(spark, sf_dir):
    f = fx(spark, sf_dir)
    return E.supporting_comments(f.edges, f.comments)


@query("dataset_overview", "E17 K6 A1", """
SELECT 'fixture' AS dataset, 'Fixture discussion' AS topic,
       'What should we change?' AS description, 'local' AS url,
       c.comments, c.accepted, p.participants
FROM (SELECT count(*) AS comments, count_if(moderated = 1) AS accepted FROM fx_comments) c,
     (SELECT count(DISTINCT voterId) AS participants FROM fx_votes) p""")
def q_dataset_overview(spark, sf_dir):
    f = fx(spark, sf_dir)
    return R.dataset_overview(f.summary, f.comments, f.votes)


_PROFILE_COLS = ["commentId", "authorId", "moderated", "topicId", "agrees", "disagrees"]


def _profile_sql() -> str:
    parts = []
    for c in _PROFILE_COLS:
        parts.append(f"""SELECT '{c}' AS "column", count(*) AS rows,
       count_if({c} IS NULL) AS nulls, CAST(min({c}) AS VARCHAR) AS min,
       CAST(max({c}) AS VARCHAR) AS max, count(DISTINCT {c}) AS distinct
FROM fx_comments""")
    return "\nUNION ALL\n".join(parts)


@query("table_profile", "B8", _profile_sql())
def q_table_profile(spark, sf_dir):
    return R.profile(fx(spark, sf_dir).comments, _PROFILE_COLS)


@query("replace_topic_arguments", "G2 F5", """
WITH acc AS (SELECT * FROM fx_comments WHERE moderated = 1),
big AS (SELECT dataset, topicId FROM acc GROUP BY dataset, topicId HAVING count(*) >= 15),
new AS (
  SELECT c.dataset, c.topicId, CAST(c.r AS BIGINT) AS argumentId,
         concat('Revised ', CAST(c.topicId AS VARCHAR), '.', CAST(c.r AS VARCHAR)) AS argumentTitle,
         c.commentText AS argumentContent
  FROM (SELECT acc.*, row_number() OVER (PARTITION BY acc.dataset, acc.topicId
                                         ORDER BY agrees DESC, commentId) AS r
        FROM acc JOIN big USING (dataset, topicId)) c
  WHERE c.r <= 2)
SELECT a.* FROM fx_arguments a
WHERE NOT EXISTS (SELECT 1 FROM new n WHERE n.dataset = a.dataset AND n.topicId = a.topicId)
UNION ALL SELECT * FROM new""")
def q_replace_topic_arguments(spark, sf_dir):
    f = fx(spark, sf_dir)
    acc = C.accepted(f.comments)
    big = (acc.groupBy("dataset", "topicId").agg(F.count("*").alias("n"))
           .filter("n >= 15").drop("n"))
    top2 = S.top_per_group(acc.join(big, ["dataset", "topicId"]), ["dataset", "topicId"],
                           [F.desc("agrees"), F.col("commentId")], 2, "r")
    lists = (top2.groupBy("dataset", "topicId")
             .agg(F.sort_array(F.collect_list(F.struct("r", "commentText"))).alias("l"))
             .select("dataset", "topicId",
                     F.transform("l", lambda x: F.concat(
                         F.lit("Revised "), F.col("topicId").cast("string"), F.lit("."),
                         x["r"].cast("string"))).alias("titles"),
                     F.col("l.commentText").alias("contents")))
    new = R.rows_from_lists(lists, ["dataset", "topicId"], "titles", "contents", start=1)
    return R.replace_partitions(f.arguments, new, ["dataset", "topicId"])


@query("first_comments", "F4 F7", f"""
SELECT {_COMMENT_COLS} FROM fx_comments ORDER BY timestamp LIMIT 20""")
def q_first_comments(spark, sf_dir):
    return R.first_rows(fx(spark, sf_dir).comments, [F.col("timestamp")], 20).select(
        *_COMMENT_LIST)


@query("weighted_support", "X2 X3 X4 X5 X6", """
WITH sv AS (
  SELECT m.dataset, m.topicId, m.argumentId, m.commentId, v.voterId, v.vote
  FROM fx_map m JOIN fx_votes v ON m.dataset = v.dataset AND m.commentId = v.commentId
  WHERE m.relationship = 'SUPPORT'),
lean AS (SELECT dataset, voterId, avg(CAST(vote AS DOUBLE)) AS mean_vote, count(*) AS n_votes
         FROM fx_votes GROUP BY dataset, voterId),
pv AS (
  SELECT sv.dataset, sv.topicId, sv.argumentId, sv.voterId,
         sum(sv.vote * c.agreeability) AS w, sum(sv.vote - l.mean_vote) AS cen,
         sum(sv.vote / l.n_votes) AS sh, max(sv.vote) - min(sv.vote) = 2 AS conflicted
  FROM sv LEFT JOIN fx_comments c ON sv.dataset = c.dataset AND sv.commentId = c.commentId
  LEFT JOIN lean l ON sv.dataset = l.dataset AND sv.voterId = l.voterId
  GROUP BY sv.dataset, sv.topicId, sv.argumentId, sv.voterId),
pa AS (
  SELECT dataset, topicId, argumentId, round(sum(w), 6) AS weighted,
         round(sum(cen), 6) AS centered, round(sum(sh), 6) AS share,
         round(count_if(conflicted) / count(*), 6) AS conflicted_share, count(*) AS voters
  FROM pv GROUP BY dataset, topicId, argumentId),
ns AS (SELECT dataset, topicId, argumentId, count(DISTINCT commentId) AS statements
       FROM fx_map WHERE relationship = 'SUPPORT' GROUP BY dataset, topicId, argumentId)
SELECT pa.*, ns.statements FROM pa JOIN ns USING (dataset, topicId, argumentId)
WHERE ns.statements >= 2""")
def q_weighted_support(spark, sf_dir):
    f = fx(spark, sf_dir)
    return S.weighted_support(f.edges, f.votes, f.comments, min_statements=2)


@query("argument_of_topic", "C7 C13", """
SELECT * FROM fx_arguments WHERE topicId = 1 AND argumentId = 0""")
def q_argument_of_topic(spark, sf_dir):
    return C.of_topic(fx(spark, sf_dir).arguments, 1, 0)


@query("topic_lookup", "C8", """
SELECT k.dataset, k.topicId, t.Title, t.Heading
FROM (SELECT DISTINCT dataset, topicId FROM fx_arguments) k
JOIN fx_topics t ON k.dataset = t.dataset AND k.topicId = t.Topic""")
def q_topic_lookup(spark, sf_dir):
    f = fx(spark, sf_dir)
    topics = f.topics.withColumnRenamed("Topic", "topicId").select("dataset", "topicId", "Title", "Heading")
    return C.exactly_one(f.arguments.select("dataset", "topicId").distinct(), topics, ["dataset", "topicId"])


@query("topic_id_range", "E16", """
SELECT dataset, min(topicId) AS first, max(topicId) AS last, max(topicId) + 1 AS next
FROM fx_arguments GROUP BY dataset""")
def q_topic_id_range(spark, sf_dir):
    return C.topic_range(fx(spark, sf_dir).arguments)
