"""Sources, sinks and the task registry on a small raw dataset layout."""

import csv
import os

from pyspark.sql import functions as F

from polyvox.functions import argdown as A
from polyvox.operators import maprender as AM
from polyvox.operators.arguments import pending
from polyvox.plans import tasks
from polyvox.sources import io
from polyvox.sources.adapters import Fixture

from polyvox_testdata import SF_SMALL


def _write_raw(spark, root, name, comments, votes, title):
    d = os.path.join(root, name)
    os.makedirs(d)
    with open(os.path.join(d, "summary.csv"), "w", newline="") as fh:
        w = csv.writer(fh)
        w.writerow(["topic", title])
        w.writerow(["conversation-description", "What should change?"])
        w.writerow(["url", "https://example.org"])
    with open(os.path.join(d, "comments.csv"), "w", newline="") as fh:
        w = csv.writer(fh)
        w.writerow(["timestamp", "datetime", "comment-id", "author-id", "agrees", "disagrees",
                    "moderated", "comment-body"])
        w.writerows(comments)
    with open(os.path.join(d, "votes.csv"), "w", newline="") as fh:
        w = csv.writer(fh)
        w.writerow(["timestamp", "datetime", "comment-id", "voter-id", "vote"])
        w.writerows(votes)


def _raw_from_fixture(spark, root):
    """Raw CSVs for two datasets built from the driver tables (sf0.001)."""
    f = Fixture(spark, SF_SMALL)
    cm = f.comments.collect()
    vt = f.votes_events.collect()
    for name, part in (("ds.one", 0), ("ds-two", 1)):
        comments = [(r.commentId, "x", r.commentId, r.authorId, r.agrees, r.disagrees, r.moderated,
                     r.commentText) for r in cm if r.commentId % 2 == part]
        votes = [(int(r.ts.timestamp()), "x", r.commentId, r.voterId, r.vote) for r in vt]
        _write_raw(spark, root, name, comments, votes, f"Title {name}, with comma")


def test_csv_readers_keep_quotes_commas_newlines(spark, tmp):
    _write_raw(spark, tmp, "a", [(1, "x", 5, 9, 2, 1, 1, 'He said "no", then\nleft')],
               [(1, "x", 5, 3, 1), (2, "x", 5, 3, -1), (3, "x", 5, 3, 0)], "T")
    c = io.read_comments(spark, tmp).collect()
    assert c[0].commentText == 'He said "no", then\nleft' and c[0].dataset == "a"
    assert abs(c[0].agreeability - 2 / 3) < 1e-12
    v = io.read_votes(spark, tmp).collect()
    assert [(r.commentId, r.voterId, r.vote, r.timestamp) for r in v] == [(5, 3, -1, 2)]
    s = {r.key: r.value for r in io.read_summary(spark, tmp).collect()}
    assert s["topic"] == "T"


def test_names_and_dynamic_overwrite(spark, tmp):
    assert io.db_table_name("a.b", "votes") == "a-b-votes"
    df = spark.createDataFrame([("x", 1), ("y", 2)], "dataset string, v int")
    io.write_table(df, tmp, "t")
    io.write_table(spark.createDataFrame([("x", 5)], "dataset string, v int"), tmp, "t")
    got = sorted((r.dataset, r.v) for r in io.read_table(spark, tmp, "t").collect())
    assert got == [("x", 5), ("y", 2)]
    assert io.exists(spark, f"{tmp}/t") and not io.exists(spark, f"{tmp}/missing")


def test_pending_skips_done_keys(spark):
    todo = spark.createDataFrame([("d", 1), ("d", 2)], "dataset string, topicId int")
    done = spark.createDataFrame([("d", 1, 0)], "dataset string, topicId int, argumentId bigint")
    assert [r.topicId for r in pending(todo, done, ["dataset", "topicId"]).collect()] == [2]


def test_renderer_pieces(spark):
    df = spark.createDataFrame([("L", "C")], "l string, c string")
    r = df.select(A.heading(F.col("l"), F.col("c")).alias("h"),
                  A.argument(F.col("l"), F.col("c"), supports_argument=F.col("l")).alias("a"),
                  A.refuted_by(F.col("l")).alias("r"), A.refutes(F.col("l")).alias("x")).first()
    assert r.h == "\n# L\n\nC\n"
    assert r.a == "\n<L>: 🤖 C #AI\n  +> <L>\n"
    assert r.r == "  - [L]\n" and r.x == "  -> [L]\n"


def test_tasks_end_to_end(spark, tmp):
    raw = os.path.join(tmp, "raw")
    os.makedirs(raw)
    _raw_from_fixture(spark, raw)
    ctx = tasks.Context(raw_root=raw, data_root=os.path.join(tmp, "data"),
                        options={"outlier_distance": 0.9})
    status = tasks.run(spark, list(tasks.TASKS), ctx)
    assert all(v == "ok" for v in status.values()), status
    ats = io.read_table(spark, ctx.data_root, "argumentTopicSupport")
    assert set(r.dataset for r in ats.select("dataset").distinct().collect()) <= {"ds.one", "ds-two"}
    maps = spark.read.text(f"{ctx.data_root}/maps/arguments-top")
    assert maps.count() > 0


def test_write_maps_orders_text(spark, tmp):
    f = Fixture(spark, SF_SMALL)
    from polyvox.operators import scoring as S
    ats = S.score(f.topics, f.arguments, f.edges, f.votes)
    lines = AM.top_map(f.summary, f.topics, f.edges, f.comments, ats)
    AM.write_maps(lines, f"{tmp}/m", partitions=4)
    parts = sorted(p for p in os.listdir(f"{tmp}/m/dataset=fixture") if p.startswith("part-"))
    text = "".join(open(f"{tmp}/m/dataset=fixture/{p}").read() for p in parts)
    assert text.startswith(A.FRONT_MATTER + "\n# Fixture discussion")
    assert text.endswith("\n")
