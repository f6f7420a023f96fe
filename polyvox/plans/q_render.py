"""Argument-map rendering queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from polyvox.functions import argdown as A
from polyvox.operators import maprender as M
from polyvox.operators import scoring as S
from polyvox.plans.catalog import query
from polyvox.plans.oracle import VIEWS
from polyvox.sources.adapters import Fixture


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_Z = "CAST(0 AS DOUBLE)"


def _keys(*ks: str) -> str:
    ks = list(ks) + [_Z] * (6 - len(ks))
    return ", ".join(f"CAST({k} AS DOUBLE) AS k{i + 1}" for i, k in enumerate(ks))


def _neg(x: str) -> str:
    return f"coalesce(-CAST({x} AS DOUBLE), CAST('inf' AS DOUBLE))"


def _pct(x: str) -> str:
    return f"coalesce(printf('%.1f', {x} * 100), 'n/a')"


VIEWS["fx_info"] = """
SELECT 'fixture' AS dataset, 'Fixture discussion' AS title, 'What should we change?' AS description"""

VIEWS["fx_map_frame"] = f"""
SELECT dataset, -1 AS section, {_keys()}, {_lit(A.FRONT_MATTER)} AS text FROM fx_info
UNION ALL
SELECT dataset, 0 AS section, {_keys()},
       chr(10) || '# ' || title || chr(10) || chr(10) || description || chr(10) AS text FROM fx_info
UNION ALL
SELECT dataset, 99 AS section, {_keys()}, chr(10) AS text FROM fx_info
UNION ALL
SELECT i.dataset, 1 AS section, {_keys('i.topicId')},
       chr(10) || '[' || t.Heading || ']: {A.AI_EMOJI} ' || t.Title || ' #AI' || chr(10) AS text
FROM (SELECT DISTINCT dataset, topicId FROM fx_ats) i
LEFT JOIN fx_topics t ON i.dataset = t.dataset AND i.topicId = t.Topic"""


_TOP_SQL = f"""
WITH top AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY dataset, topicId
                 ORDER BY agreeability DESC NULLS LAST, argumentId) AS rank FROM fx_ats)
  WHERE rank <= 3),
best AS (SELECT dataset, topicId, max(agreeability) AS b FROM top GROUP BY dataset, topicId),
j AS (
  SELECT t.dataset, t.topicId, t.argumentId, t.argumentTitle, m.commentId,
         c.commentText, c.agrees, c.disagrees,
         CAST(c.agrees AS DOUBLE) / nullif(c.agrees + c.disagrees, 0) AS agreeability
  FROM top t
  JOIN (SELECT * FROM fx_map WHERE relationship = 'SUPPORT') m
    ON t.dataset = m.dataset AND t.topicId = m.topicId AND t.argumentId = m.argumentId
  LEFT JOIN fx_comments c ON m.dataset = c.dataset AND m.commentId = c.commentId),
tc AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY dataset, topicId, argumentId
                                                   ORDER BY agrees DESC NULLS LAST, commentId) AS r
                      FROM j) WHERE r <= 3),
cbest AS (SELECT dataset, topicId, argumentId, max(agrees) AS b FROM tc
          GROUP BY dataset, topicId, argumentId)
SELECT * FROM fx_map_frame
UNION ALL
SELECT t.dataset, 2 AS section,
       {_keys(_neg('b.b'), 't.topicId', _neg('t.agreeability'), 't.argumentId')},
       chr(10) || '<' || t.argumentTitle || '>: {A.AI_EMOJI} ' || t.argumentContent || ' _('
       || CAST(t.agrees + t.disagrees AS VARCHAR) || ' voters approximated, '
       || {_pct('t.agreeability')} || '% tend to agree_) #AI' || chr(10)
       || '  +> [' || t.topicHeading || ']' || chr(10) AS text
FROM top t JOIN best b ON t.dataset = b.dataset AND t.topicId = b.topicId
UNION ALL
SELECT c.dataset, 3 AS section,
       {_keys(_neg('b.b'), 'c.topicId', 'c.argumentId', _neg('c.agrees'), 'c.commentId')},
       chr(10) || '[Comment ' || CAST(c.commentId AS VARCHAR) || ']: {A.HUMAN_EMOJI} '
       || c.commentText || ' _(' || CAST(c.agrees + c.disagrees AS VARCHAR) || ' votes, '
       || {_pct('c.agreeability')} || '% agree_) #Human' || chr(10)
       || '  +> <' || c.argumentTitle || '>' || chr(10) AS text
FROM tc c JOIN cbest b ON c.dataset = b.dataset AND c.topicId = b.topicId
                      AND c.argumentId = b.argumentId"""


@query("argdown_top", "K2 R1 R2 R3 R4 R8 R9 I11 F1 F2 F6", _TOP_SQL)
def q_argdown_top(spark, sf_dir):
    f = Fixture(spark, sf_dir)
    ats = S.score(f.topics, f.arguments, f.edges, f.votes)
    return M.top_map(f.summary, f.topics, f.edges, f.comments, ats)


@query("argdown_all", "K3 R1 R2 R3 R4 R5 R9 I11 E11 D9 D10", f"""
WITH sup AS (SELECT * FROM fx_map WHERE relationship = 'SUPPORT'),
links AS (SELECT s.dataset, s.topicId, s.argumentId, s.commentId, a.argumentTitle
          FROM sup s LEFT JOIN fx_arguments a ON s.dataset = a.dataset AND s.topicId = a.topicId
                                              AND s.argumentId = a.argumentId)
SELECT * FROM fx_map_frame
UNION ALL
SELECT dataset, 2 AS section, {_keys(_neg('agreeability'), 'topicId', 'argumentId')},
       chr(10) || '<' || argumentTitle || '>: {A.AI_EMOJI} ' || argumentContent || ' ('
       || CAST(agrees + disagrees AS VARCHAR) || ' voters approximated, '
       || {_pct('agreeability')} || '% tend to agree) #AI' || chr(10)
       || '  +> [' || topicHeading || ']' || chr(10) AS text
FROM fx_ats
UNION ALL
SELECT i.dataset, 3 AS section, {_keys('i.commentId')},
       chr(10) || '[Comment ' || CAST(i.commentId AS VARCHAR) || ']: {A.HUMAN_EMOJI} '
       || c.commentText || ' (' || CAST(c.agrees + c.disagrees AS VARCHAR) || ' votes, '
       || {_pct('c.agreeability')} || '% agree) #Human' || chr(10) AS text
FROM (SELECT DISTINCT dataset, commentId FROM sup) i
LEFT JOIN fx_comments c ON i.dataset = c.dataset AND i.commentId = c.commentId
UNION ALL
SELECT DISTINCT dataset, 4 AS section, {_keys('topicId', 'argumentId', '-1')},
       chr(10) || '<' || coalesce(argumentTitle, 'None') || '>' || chr(10) AS text
FROM links
UNION ALL
SELECT dataset, 4 AS section, {_keys('topicId', 'argumentId', 'commentId')},
       '  + [Comment ' || CAST(commentId AS VARCHAR) || ']' || chr(10) AS text
FROM links""")
def q_argdown_all(spark, sf_dir):
    f = Fixture(spark, sf_dir)
    ats = S.score(f.topics, f.arguments, f.edges, f.votes)
    return M.all_map(f.summary, f.topics, f.arguments, f.edges, f.comments, ats)


@query("argdown_markdown_map", "R10 K2", _TOP_SQL + f"""
UNION ALL
SELECT i.dataset, v.s AS section, {_keys()}, v.text
FROM fx_info i, (VALUES (-2, '```argdown-map' || chr(10)), (100, chr(10) || '```' || chr(10))) v(s, text)""")
def q_argdown_markdown_map(spark, sf_dir):
    return M.fenced(q_argdown_top(spark, sf_dir))


@query("argdown_markdown_arguments", "R10 R3 R9", f"""
SELECT dataset, topicId, argumentId,
       '```argdown' || chr(10) || {_lit(A.FRONT_MATTER)} || chr(10) || '<' || argumentTitle || '>: {A.AI_EMOJI} ' || argumentContent
       || ' #AI' || chr(10) || '  +> [' || topicHeading || ']' || chr(10) || chr(10) || chr(10) || '```' || chr(10) AS text
FROM fx_ats""")
def q_argdown_markdown_arguments(spark, sf_dir):
    """Each scored argument as a Markdown document of its own."""
    f = Fixture(spark, sf_dir)
    ats = S.score(f.topics, f.arguments, f.edges, f.votes)
    return ats.select("dataset", "topicId", "argumentId", A.markdown(
        A.argument(F.col("argumentTitle"), F.col("argumentContent"), F.col("topicHeading"))).alias("text"))
