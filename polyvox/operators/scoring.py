"""Argument scoring and ranking.

One voter counts once per argument: their votes on all statements that
support the argument are summed, and only the sign of the sum counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from polyvox.functions.exprs import agreeability, vote_sign
from polyvox.operators.skew import salted_join

ARG_KEYS = ["dataset", "topicId", "argumentId"]


def supporting(edges: DataFrame) -> DataFrame:
    """SUPPORT edges only."""
    return edges.filter(F.col("relationship") == "SUPPORT")


def support_votes(edges: DataFrame, votes: DataFrame) -> DataFrame:
    """C9 + D3: (argument, voter, vote) for every vote on a supporting comment.

    The one large shuffle join. Popular comments are split by voter hash
    (``salted_join``), so a comment with a third of all votes still spreads
    over many tasks.
    """
    e = supporting(edges).select("dataset", "commentId", "topicId", "argumentId")
    v = votes.filter(F.col("vote") != 0).select("dataset", "commentId", "voterId", "vote")
    return salted_join(v, e, ["dataset", "commentId"], spread_by=["voterId"])


def voter_net_vote(edges: DataFrame, votes: DataFrame) -> DataFrame:
    """E2 + I3 + I4: net vote of each voter on each argument, as a sign."""
    net = (support_votes(edges, votes)
           .groupBy(*ARG_KEYS, "voterId")
           .agg(F.sum("vote").alias("net")))
    return net.select(*ARG_KEYS, "voterId", vote_sign("net").alias("vote"),
                      (F.col("net") > 0).alias("agree"), (F.col("net") < 0).alias("disagree"))


def argument_support(per_voter: DataFrame) -> DataFrame:
    """E3 + I2: support, agrees, disagrees, agreeability per argument."""
    return (per_voter.groupBy(*ARG_KEYS)
            .agg(F.sum("vote").cast("bigint").alias("support"),
                 F.count_if("agree").alias("agrees"),
                 F.count_if("disagree").alias("disagrees"))
            .withColumn("agreeability", agreeability()))


def score(topics: DataFrame, arguments: DataFrame, edges: DataFrame,
          votes: DataFrame) -> DataFrame:
    """K1: argumentTopicSupport.

    Arguments and topics are small per dataset but grow with the number of
    datasets, so no broadcast is forced; AQE turns these joins into
    broadcast joins when the runtime size is under the broadcast threshold
    and keeps a shuffle join otherwise. No sort: ordering is an output
    concern (use ``ranked``).
    """
    sup = argument_support(voter_net_vote(edges, votes))
    t = topics.select("dataset", F.col("Topic").alias("topicId"),
                      F.col("Title").alias("topicTitle"),
                      F.col("Heading").alias("topicHeading"))
    return (sup.join(arguments, ARG_KEYS, "left")
            .join(t, ["dataset", "topicId"], "left"))


def ranked(df: DataFrame, metric: str = "agreeability") -> DataFrame:
    """F8: best first with NULL (no voters) last, ids as total tie-break."""
    return df.orderBy(F.desc_nulls_last(metric), *ARG_KEYS)


def top_per_group(df: DataFrame, group: list[str], order: list, n: int,
                  rank_col: str = "rank") -> DataFrame:
    """first ``n`` rows per group by ``order`` (1-based ``rank``).

    ``row_number() <= n`` lets Spark insert a per-partition group limit
    before the shuffle (InferWindowGroupLimit)."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= n)


def top_arguments(support: DataFrame, n: int = 3) -> DataFrame:
    """top-n arguments per topic by agreeability."""
    return top_per_group(support, ["dataset", "topicId"],
                         [F.desc_nulls_last("agreeability"), F.col("argumentId")], n)


def strongest_arguments(support: DataFrame, n: int = 2) -> DataFrame:
    """Top-n per topic with titles, for a global best-first report."""
    return top_arguments(support, n).select(
        "dataset", "topicId", "topicTitle", "argumentId", "argumentTitle",
        "support", "agrees", "disagrees", "agreeability", "rank")


def top_comments(top_args: DataFrame, edges: DataFrame, comments: DataFrame,
                 n: int = 3) -> DataFrame:
    """D8 + F2: for each top argument, its n supporting comments with most agrees."""
    e = supporting(edges).select("dataset", "topicId", "argumentId", "commentId")
    c = comments.select("dataset", "commentId", "commentText", "agrees", "disagrees",
                        agreeability().alias("agreeability"))
    joined = (top_args.select(*ARG_KEYS, "argumentTitle")
              .join(e, ARG_KEYS, "left")
              .join(c, ["dataset", "commentId"], "left"))
    return top_per_group(joined, ARG_KEYS, [F.desc_nulls_last("agrees"), F.col("commentId")],
                         n, rank_col="commentRank")


def refute_samples(edges: DataFrame, arguments: DataFrame, comments: DataFrame,
                   topics: DataFrame) -> DataFrame:
    """K4 (C11, D11, E12): one refuting edge per topic, lowest (commentId,
    argumentId), with argument/topic titles, comment text and tallies, and the
    first element of the edge's ``reasoning`` list where edges have one (I15;
    NULL for an empty list)."""
    ref = edges.filter(F.col("relationship") == "REFUTE")
    why = [F.get("reasoning", 0).alias("reasoning")] if "reasoning" in edges.columns else []
    first = (ref.groupBy("dataset", "topicId")
             .agg(F.min(F.struct("commentId", "argumentId", *why)).alias("__k"))
             .select("dataset", "topicId", "__k.*"))
    t = topics.select("dataset", F.col("Topic").alias("topicId"),
                      F.col("Title").alias("topicTitle"))
    return (first.join(arguments.select(*ARG_KEYS, "argumentTitle"), ARG_KEYS, "left")
            .join(comments.select("dataset", "commentId", "commentText", "agrees", "disagrees"),
                  ["dataset", "commentId"], "left")
            .join(t, ["dataset", "topicId"], "left"))


def weighted_support(edges: DataFrame, votes: DataFrame, comments: DataFrame,
                     min_statements: int = 1) -> DataFrame:
    """X2-X6 alternatives to K1 per argument:

    * ``weighted`` (X2): sum of vote x statement agreeability,
    * ``centered`` (X3): sum of (vote - voter's mean vote),
    * ``share`` (X4): sum of vote / voter's vote count,
    * ``conflicted_share`` (X6): share of voters with both +1 and -1 votes
      on the argument's statements,
    * kept only with at least ``min_statements`` supporting statements (X5).
    """
    sums = _vote_sums(edges, votes)
    c = comments.select("dataset", "commentId", "agreeability")
    per_arg = (supporting(edges).select(*ARG_KEYS, "commentId")
               .join(sums.join(c, ["dataset", "commentId"], "left"), ["dataset", "commentId"])
               .groupBy(*ARG_KEYS)
               .agg(F.round(F.sum(F.col("__net") * F.col("agreeability")), 6).alias("weighted"),
                    F.round(F.sum("__cen"), 6).alias("centered"),
                    F.round(F.sum("__sh"), 6).alias("share")))
    n_stmt = (supporting(edges).groupBy(*ARG_KEYS)
              .agg(F.count_distinct("commentId").alias("statements")))
    return (per_arg.join(_argument_voters(edges, votes), ARG_KEYS).join(n_stmt, ARG_KEYS)
            .filter(F.col("statements") >= min_statements)
            .select(*ARG_KEYS, "weighted", "centered", "share", "conflicted_share", "voters", "statements"))


def _vote_sums(edges: DataFrame, votes: DataFrame) -> DataFrame:
    """(dataset, commentId, __net, __cen, __sh) of every voted comment that supports an argument: the sums of its
    votes, of votes less their voter's mean, and of votes over their voter's number of votes.

    X2-X4 are sums over votes, so a comment's sums are made once, however many arguments it supports."""
    lean = (votes.groupBy("dataset", "voterId")
            .agg(F.avg(F.col("vote").cast("double")).alias("mean_vote"),
                 F.count("*").alias("n_votes")))
    found = supporting(edges).select("dataset", "commentId").distinct()
    v = votes.filter(F.col("vote") != 0).select("dataset", "commentId", "voterId", "vote")
    return (salted_join(v, found, ["dataset", "commentId"], spread_by=["voterId"])
            .join(lean, ["dataset", "voterId"], "left").groupBy("dataset", "commentId")
            .agg(F.sum("vote").alias("__net"), F.sum(F.col("vote") - F.col("mean_vote")).alias("__cen"),
                 F.sum(F.col("vote") / F.col("n_votes")).alias("__sh")))


#: Arguments of a topic whose bits share a number (the sign bit is left alone).
ARGUMENT_BITS = 63


def _argument_voters(edges: DataFrame, votes: DataFrame) -> DataFrame:
    """(dataset, topicId, argumentId, voters, conflicted_share): voters on an argument's statements, and the share of
    them with votes of both signs.

    A comment's arguments are the bits of one number per topic and ``ARGUMENT_BITS`` argument ids, so a vote moves once
    per topic instead of once per argument, and a voter's state is two numbers, for agreement and disagreement."""
    bit = F.pmod("argumentId", F.lit(ARGUMENT_BITS)).cast("int")
    e = supporting(edges).filter(F.col("argumentId").isNotNull()).select(
        "dataset", "commentId", "topicId", F.floor(F.col("argumentId") / ARGUMENT_BITS).alias("__block"),
        F.call_function("shiftleft", F.lit(1).cast("bigint"), bit).alias("__bit"))
    masks = e.groupBy("dataset", "commentId", "topicId", "__block").agg(F.bit_or("__bit").alias("__mask"))
    v = votes.filter(F.col("vote") != 0).select("dataset", "commentId", "voterId", "vote")
    of = lambda cond: F.bit_or(F.when(cond, F.col("__mask")).otherwise(F.lit(0).cast("bigint")))
    per_voter = (salted_join(v, masks, ["dataset", "commentId"], spread_by=["voterId"])
                 .groupBy("dataset", "topicId", "__block", "voterId")
                 .agg(of(F.col("vote") > 0).alias("__up"), of(F.col("vote") < 0).alias("__down")))
    has = lambda mask, i: F.call_function("shiftright", mask, i).bitwiseAND(F.lit(1).cast("bigint")) == 1
    bits = F.sequence(F.lit(0), F.lit(ARGUMENT_BITS - 1))
    on = per_voter.select("dataset", "topicId", "__block", "__up", "__down", F.explode(
        F.filter(bits, lambda i: has(F.col("__up").bitwiseOR(F.col("__down")), i))).alias("__i"))
    return (on.groupBy("dataset", "topicId", (F.col("__block") * ARGUMENT_BITS + F.col("__i")).alias("argumentId"))
            .agg(F.count("*").alias("voters"),
                 F.round(F.count_if(has(F.col("__up").bitwiseAND(F.col("__down")), F.col("__i"))) / F.count("*"), 6).alias("conflicted_share")))
