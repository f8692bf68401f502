"""Vote-driven analytics: q01, q04, q07, q09, q14, q19, q26, q27, q29.

Shape rules used throughout:
- votes are the largest table; they are filtered by type and pre-aggregated
  per post (partial aggregation before the shuffle) before any join, so a
  post with millions of votes becomes one row and cannot skew a join;
- a user's own posts are a selective filter; the join between them and the
  votes is left to AQE (broadcast when measured small, sort-merge otherwise);
- only frames with a proven size bound (one row, or a LIMIT result) get an
  explicit ``broadcast``.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.pg import days_between, ratio, rounded_ratio, weekday_name, weekday_sunday0

UP, DOWN, BOUNTY = 2, 3, 9


def _votes_per_post(votes: DataFrame, types: tuple[int, ...]) -> DataFrame:
    """(post_id, n, up, down): votes of the given types counted per post."""
    return (votes.where(F.col("vote_type_id").isin(*types))
            .groupBy("post_id")
            .agg(F.count(F.lit(1)).alias("n"),
                 F.count_if(F.col("vote_type_id") == UP).alias("up"),
                 F.count_if(F.col("vote_type_id") == DOWN).alias("down")))


def _my_upvotes_by_parent(posts: DataFrame, votes: DataFrame, me: int,
                          non_community: bool = False) -> DataFrame:
    """(parent_id, n): up-votes on my posts that have a parent, per parent."""
    mine = posts.where((F.col("owner_user_id") == F.lit(me)) & F.col("parent_id").isNotNull())
    if non_community:
        mine = mine.where(F.col("community_owned_date").isNull())
    mine = mine.select("id", "parent_id")
    # one user's posts are usually few: filter the votes and join them raw
    # (AQE broadcasts ``mine`` when it is measured small, so the votes are
    # never shuffled); the per-parent count is partially aggregated after.
    up = votes.where(F.col("vote_type_id") == UP).select("post_id")
    return (mine.join(up, mine["id"] == up["post_id"])
            .groupBy("parent_id").agg(F.count(F.lit(1)).alias("n")))


def _upvotes_per_tag(posts, post_tags, votes, me, key, non_community=False) -> DataFrame:
    per_parent = _my_upvotes_by_parent(posts, votes, me, non_community)
    return (per_parent.join(post_tags, post_tags["post_id"] == per_parent["parent_id"])
            .groupBy(key).agg(F.sum("n").alias("up_votes")))


def q01_upvotes_per_tag(posts: DataFrame, post_tags: DataFrame, votes: DataFrame,
                        me: int = 15811) -> DataFrame:
    """Up-votes on my posts that have a parent, per tag of the parent."""
    return (_upvotes_per_tag(posts, post_tags, votes, me, "tag_name")
            .select("tag_name", "up_votes")
            .orderBy(F.desc("up_votes"), F.asc("tag_name")))


def q14_tag_badge_progress(posts: DataFrame, post_tags: DataFrame, votes: DataFrame,
                           me: int = 15811, limit: int = 20) -> DataFrame:
    """As q01, over my non-community posts only; top ``limit`` tags."""
    return (_upvotes_per_tag(posts, post_tags, votes, me, "tag_name", non_community=True)
            .select("tag_name", "up_votes")
            .orderBy(F.desc("up_votes"), F.asc("tag_name")).limit(limit))


def q04_interesting_unanswered(posts: DataFrame, post_tags: DataFrame, votes: DataFrame,
                               users: DataFrame, me: int = 15811, top_tags: int = 20,
                               limit: int = 2000) -> DataFrame:
    """Unanswered questions in my top tags, by tag votes, asker and score."""
    top = (_upvotes_per_tag(posts, post_tags, votes, me, "tag_id")
           .orderBy(F.desc("up_votes"), F.asc("tag_id")).limit(top_tags))
    # the top list is LIMIT-bounded: broadcasting it is safe at any scale
    tag_votes = (post_tags.join(F.broadcast(top), "tag_id")
                 .groupBy("post_id").agg(F.sum("up_votes").alias("tag_votes")))
    open_q = posts.where(F.col("parent_id").isNull()
                         & F.col("community_owned_date").isNull()
                         & F.col("closed_date").isNull()
                         & F.col("accepted_answer_id").isNull()
                         ).select("id", "score", "owner_user_id")
    scored_answers = posts.where(F.col("parent_id").isNotNull() & (F.col("score") > 0)
                                 ).select(F.col("parent_id").alias("qid"))
    # the top tags select questions first: only those are looked up among the answers
    tagged = open_q.where(F.col("owner_user_id").isNotNull()).join(tag_votes, open_q["id"] == tag_votes["post_id"])
    unanswered = tagged.join(scored_answers, F.col("id") == F.col("qid"), "left_anti")
    askers = users.select(F.col("id").alias("uid"), "reputation")
    j = unanswered.join(askers, F.col("owner_user_id") == F.col("uid"))
    # weight = tag_votes/10 + reputation/200 + score*100, kept exact as n/200
    num = (F.col("tag_votes") * 20 + F.col("reputation").cast("long")
           + F.col("score").cast("long") * 20000)
    return (j.select(F.col("id").alias("post_id"), num.alias("_num"))
            .select("post_id", ratio(F.col("_num"), F.lit(200)).alias("weight"), "_num")
            .orderBy(F.desc_nulls_first("_num"), F.asc("post_id")).limit(limit)
            .select("post_id", "weight"))


def q07_passive_reputation(posts: DataFrame, votes: DataFrame, me: int = 15811,
                           ignore_days: int = 15, min_age_days: int = 60,
                           limit: int = 100) -> DataFrame:
    """My posts' reputation from votes cast after the first ``ignore_days``."""
    latest = posts.agg(F.max("creation_date")).scalar()  # the dump's end
    mine = (posts.where((F.col("owner_user_id") == F.lit(me))
                        & F.col("community_owned_date").isNull())
            .select("id", "parent_id", "creation_date", latest.alias("latest"))
            .where(days_between(F.col("latest"), F.col("creation_date")) > min_age_days))
    v = (votes.where(F.col("vote_type_id").isin(UP, DOWN))
         .select("post_id", "vote_type_id", F.col("creation_date").alias("voted")))
    j = (mine.join(v, mine["id"] == v["post_id"])
         .where(days_between(F.col("voted"), F.col("creation_date")) > ignore_days))
    up_pts = F.when(F.col("parent_id").isNull(), F.lit(5)).otherwise(F.lit(10))
    stats = (j.groupBy("id", "creation_date", "latest")
             .agg(F.sum(F.when(F.col("vote_type_id") == UP, up_pts).otherwise(0)).alias("up_rep"),
                  F.sum(F.when(F.col("vote_type_id") == DOWN, 2).otherwise(0)).alias("down_rep")))
    days = (days_between(F.col("latest"), F.col("creation_date")) - F.lit(ignore_days))
    return (stats.select(
                F.col("id").alias("post_id"),
                ratio(F.col("up_rep") - F.col("down_rep"), days).alias("passive_rep_per_day"),
                (F.col("up_rep") - F.col("down_rep")).alias("passive_rep"),
                "up_rep", "down_rep",
                days.cast("int").alias("days_counted"))
            .orderBy(F.desc_nulls_first("passive_rep_per_day"), F.asc("post_id"))
            .limit(limit))


def q09_controversial(posts: DataFrame, votes: DataFrame, ratio_: float | Decimal = Decimal("0.5"),
                      limit: int = 100) -> DataFrame:
    """Open, non-wiki posts whose down-votes exceed ``ratio_`` x up-votes."""
    vs = _votes_per_post(votes, (UP, DOWN))
    open_posts = posts.where(F.col("community_owned_date").isNull()
                             & F.col("closed_date").isNull()).select("id")
    r = F.lit(Decimal(str(ratio_)))
    return (vs.where(F.col("down") > F.col("up") * r)
            .join(open_posts, vs["post_id"] == open_posts["id"])
            .select(F.col("id").alias("post_id"), "up", "down")
            .orderBy(F.desc("up"), F.asc("post_id")).limit(limit))


def q19_dangerous_tags(posts: DataFrame, post_tags: DataFrame, votes: DataFrame,
                       tags: DataFrame, min_questions: int = 1000) -> DataFrame:
    """Down/up vote ratio on answers, per tag with >= ``min_questions`` posts."""
    big_tags = (post_tags.groupBy("tag_id").agg(F.count(F.lit(1)).alias("nq"))
                .where(F.col("nq") >= min_questions).select("tag_id"))
    vpp = _votes_per_post(votes, (UP, DOWN))
    answers = posts.where(F.col("parent_id").isNotNull()).select("id", "parent_id")
    per_question = (answers.join(vpp, answers["id"] == vpp["post_id"])
                    .groupBy("parent_id").agg(F.sum("up").alias("up"), F.sum("down").alias("down")))
    per_tag = (post_tags.join(big_tags, "tag_id")
               .join(per_question, post_tags["post_id"] == per_question["parent_id"])
               .groupBy("tag_id").agg(F.sum("up").alias("upvotes"), F.sum("down").alias("downvotes")))
    names = tags.select(F.col("id").alias("tag_id"), "tag_name")
    return (per_tag.join(names, "tag_id")
            .select("tag_name", "upvotes", "downvotes",
                    rounded_ratio(F.col("downvotes") * 100, F.nullif(F.col("upvotes"), F.lit(0)), 2)
                    .alias("du_ratio"))
            .orderBy(F.desc_nulls_first("du_ratio"), F.asc("tag_name")))


def q26_bounties_won(posts: DataFrame, votes: DataFrame, limit: int = 100) -> DataFrame:
    """Bounty-awarded votes per post owner; a NULL owner is one group."""
    per_post = (votes.where(F.col("vote_type_id") == BOUNTY)
                .groupBy("post_id").agg(F.count(F.lit(1)).alias("n")))
    owners = posts.select("id", "owner_user_id")
    return (per_post.join(owners, per_post["post_id"] == owners["id"])
            .groupBy(F.col("owner_user_id").alias("user_id"))
            .agg(F.sum("n").alias("bounties_won"))
            .orderBy(F.desc("bounties_won"), F.asc_nulls_last("user_id")).limit(limit))


def q27_votes_by_weekday(posts: DataFrame, votes: DataFrame) -> DataFrame:
    """Up/down votes per post type and weekday of the post (Sunday first)."""
    vpp = _votes_per_post(votes, (UP, DOWN))
    p = (posts.where(F.col("post_type_id").isin(1, 2))
         .select("id", "post_type_id",
                 weekday_sunday0(F.col("creation_date")).alias("dow"),
                 weekday_name(F.col("creation_date")).alias("day")))
    g = (vpp.join(p, vpp["post_id"] == p["id"])
         .groupBy("post_type_id", "dow", "day")
         .agg(F.sum("n").alias("amount"), F.sum("up").alias("up_votes"),
              F.sum("down").alias("down_votes")))
    return (g.orderBy(F.asc("post_type_id"), F.asc_nulls_last("dow"))
            .select(F.when(F.col("post_type_id") == 1, "Question").otherwise("Answer").alias("post_type"),
                    "day", "amount", "up_votes", "down_votes",
                    rounded_ratio(F.col("up_votes"), F.nullif(F.col("down_votes"), F.lit(0)), 4)
                    .alias("ratio")))


def q29_bounties_by_month(posts: DataFrame, votes: DataFrame) -> DataFrame:
    """Questions and awarded bounties per calendar month, full outer joined."""
    ym = [F.year("creation_date").cast("int").alias("year"),
          F.month("creation_date").cast("int").alias("month")]
    qm = (posts.where(F.col("post_type_id") == 1).groupBy(*ym)
          .agg(F.count(F.lit(1)).alias("questions")))
    bm = (votes.where(F.col("vote_type_id") == BOUNTY).groupBy(*ym)
          .agg(F.count(F.lit(1)).alias("bounties"),
               F.sum("bounty_amount").cast("long").alias("amount")))
    q, b = qm.alias("q"), bm.alias("b")
    j = q.join(b, (F.col("q.year") == F.col("b.year")) & (F.col("q.month") == F.col("b.month")),
               "full_outer")
    return (j.select(F.coalesce("q.year", "b.year").alias("year"),
                     F.coalesce("q.month", "b.month").alias("month"),
                     F.col("b.bounties").alias("bounties"), F.col("b.amount").alias("amount"),
                     F.col("q.questions").alias("questions"))
            .orderBy(F.asc_nulls_last("year"), F.asc_nulls_last("month")))
