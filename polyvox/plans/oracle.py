"""DuckDB twins of the adapter views and query oracles.

``VIEWS`` mirrors ``polyvox.sources.adapters`` in plain SQL over the driver
tables; ``with_views(sql)`` prefixes a query with the CTEs it names (and
their dependencies, in order).
"""

from __future__ import annotations

import re

VIEWS: dict[str, str] = {}

VIEWS["fx_votes_raw"] = """
SELECT 'fixture' AS dataset,
       l.l_partkey % (SELECT count(*) FROM documents) AS commentId,
       o.o_custkey AS voterId,
       CAST(CASE l.l_returnflag WHEN 'A' THEN 1 WHEN 'R' THEN -1 ELSE 0 END AS INTEGER) AS vote,
       l.l_shipdate AS ts, l.l_orderkey, l.l_linenumber, l.l_suppkey
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"""

VIEWS["fx_votes_events"] = """
SELECT 'fixture' AS dataset,
       CAST(json_extract_string(props, '$.k') AS BIGINT) AS commentId,
       user_id AS voterId,
       CAST(CASE WHEN event_type IN ('purchase', 'signup') THEN 1
                 WHEN event_type = 'error' THEN -1 ELSE 0 END AS INTEGER) AS vote,
       ts, event_id
FROM events"""

VIEWS["fx_votes"] = """
SELECT dataset, commentId, voterId, vote, ts AS timestamp FROM (
  SELECT *, row_number() OVER (PARTITION BY dataset, commentId, voterId
                               ORDER BY ts DESC, l_orderkey DESC, l_linenumber DESC,
                                        l_suppkey DESC) AS rn
  FROM fx_votes_raw WHERE vote <> 0) WHERE rn = 1"""

VIEWS["fx_tally"] = """
SELECT dataset, commentId, count_if(vote = 1) AS agrees, count_if(vote = -1) AS disagrees
FROM fx_votes GROUP BY dataset, commentId"""

VIEWS["fx_comments"] = """
SELECT *, CASE WHEN agrees + disagrees = 0 THEN CAST(0 AS DOUBLE)
               ELSE agrees / (agrees + disagrees) END AS agreeability
FROM (
  SELECT 'fixture' AS dataset, d.doc_id AS commentId, d.doc_id % 97 AS authorId,
         d.doc_id AS timestamp, d.text AS commentText,
         CAST(CASE WHEN l.doc_id IS NULL THEN 0
                   WHEN l.quality = 1 AND l.toxic = 0 THEN 1 ELSE -1 END AS INTEGER) AS moderated,
         CAST(substr(d.source, 4) AS INTEGER) AS topicId,
         coalesce(t.agrees, 0) AS agrees, coalesce(t.disagrees, 0) AS disagrees
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
  LEFT JOIN fx_tally t ON t.commentId = d.doc_id)"""

VIEWS["fx_topics"] = """
SELECT DISTINCT 'fixture' AS dataset, CAST(substr(source, 4) AS INTEGER) AS Topic,
       concat('Title of ', source) AS Title, source AS Heading
FROM documents"""

VIEWS["fx_arguments"] = """
SELECT dataset, topicId, CAST(rk - 1 AS BIGINT) AS argumentId,
       concat('Argument ', CAST(topicId AS VARCHAR), '.', CAST(rk - 1 AS VARCHAR)) AS argumentTitle,
       commentText AS argumentContent
FROM (
  SELECT dataset, topicId, commentText,
         row_number() OVER (PARTITION BY dataset, topicId
                            ORDER BY agreeability DESC, agrees DESC, commentId) AS rk,
         count(*) OVER (PARTITION BY dataset, topicId) AS n
  FROM fx_comments WHERE moderated = 1)
WHERE rk <= CASE WHEN n <= 1 THEN 0 ELSE CAST(ceil(ln(n) * 2) AS INTEGER) END"""

VIEWS["fx_map"] = """
SELECT c.dataset, c.commentId, c.topicId, a.argumentId,
       CASE WHEN ((c.commentId % 83) * 7 + a.argumentId * 3) % 10 < 3 THEN 'SUPPORT'
            WHEN ((c.commentId % 83) * 7 + a.argumentId * 3) % 10 = 9 THEN 'REFUTE'
            ELSE 'UNRELATED' END AS relationship
FROM fx_comments c JOIN fx_arguments a ON c.dataset = a.dataset AND c.topicId = a.topicId
WHERE c.moderated = 1"""

VIEWS["fx_support"] = """
WITH v AS (
  SELECT m.dataset, m.topicId, m.argumentId, v.voterId, sign(sum(v.vote)) AS s
  FROM fx_map m JOIN fx_votes v ON m.dataset = v.dataset AND m.commentId = v.commentId
  WHERE m.relationship = 'SUPPORT' AND v.vote <> 0
  GROUP BY m.dataset, m.topicId, m.argumentId, v.voterId)
SELECT dataset, topicId, argumentId, CAST(sum(s) AS BIGINT) AS support,
       count_if(s > 0) AS agrees, count_if(s < 0) AS disagrees,
       CAST(count_if(s > 0) AS DOUBLE) / nullif(count_if(s > 0) + count_if(s < 0), 0) AS agreeability
FROM v GROUP BY dataset, topicId, argumentId"""

VIEWS["fx_ats"] = """
SELECT g.*, a.argumentTitle, a.argumentContent, t.Title AS topicTitle, t.Heading AS topicHeading
FROM fx_support g
LEFT JOIN fx_arguments a ON g.dataset = a.dataset AND g.topicId = a.topicId
                         AND g.argumentId = a.argumentId
LEFT JOIN fx_topics t ON g.dataset = t.dataset AND g.topicId = t.Topic"""


def _deps(sql: str) -> list[str]:
    names = set(re.findall(r"\b(fx_\w+)\b", sql))
    return [n for n in VIEWS if n in names]


def with_views(sql: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``sql`` with the CTEs it (transitively) references."""
    views = dict(VIEWS)
    views.update(extra or {})
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for d in re.findall(r"\b(fx_\w+)\b", views[name]):
            if d != name and d in views:
                visit(d)
        order.append(name)

    for n in re.findall(r"\b(fx_\w+)\b", sql):
        if n in views:
            visit(n)
    if not order:
        return sql
    ctes = ",\n".join(f"{n} AS ({views[n]}\n)" for n in order)
    body = sql.lstrip()
    if re.match(r"(?i)WITH\s", body):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
