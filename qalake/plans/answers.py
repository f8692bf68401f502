"""Answer/question analytics: q02, q05, q08, q10, q15, q20, q23, q32, q34.

Most are a self-join answer -> question on the question key. The answer side
is filtered first; where the group key is a user, the count is aggregated per
owner before the (unique-key) join with ``users``, so the users table is only
ever joined with one row per qualifying user.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.pg import fail_if, idiv, ratio, rounded_ratio


def _user_ids(users: DataFrame) -> DataFrame:
    return users.select(F.col("id").alias("user_id"))


def q02_unsung(posts: DataFrame, me: int = 15811) -> DataFrame:
    """My accepted answers on others' questions: scored vs zero-scored."""
    a = (posts.where(F.col("community_owned_date").isNull()
                     & (F.col("owner_user_id") == F.lit(me))
                     & (F.col("post_type_id") == 2))
         .select(F.col("id").alias("aid"), "parent_id", "score"))
    q = posts.select(F.col("id").alias("qid"), F.col("owner_user_id").alias("q_owner"),
                     "accepted_answer_id")
    j = (a.join(q, (a["parent_id"] == q["qid"]) & (q["accepted_answer_id"] == a["aid"]))
         .where(F.col("q_owner") != F.lit(me)))
    zero = F.col("score") == 0
    g = j.agg(F.count("aid").alias("accepted_answers"),
              F.sum(F.when(zero, 0).otherwise(1)).alias("scored_answers"),
              F.sum(F.when(zero, 1).otherwise(0)).alias("unscored_answers"))
    # (unscored * 1000 / count) is integer division, then / 10.0
    pct = ratio(idiv(F.col("unscored_answers") * 1000, F.nullif(F.col("accepted_answers"), F.lit(0))),
                F.lit(10))
    return g.select("accepted_answers", "scored_answers", "unscored_answers",
                    pct.alias("percentage_unscored"))


def q05_accept_rate(posts: DataFrame, me: int = 15811, safe: bool = False) -> DataFrame:
    """Share of my answers that were accepted, in percent.

    No answers at all is a division by zero: an error, or NULL with ``safe``.
    """
    a = (posts.where((F.col("owner_user_id") == F.lit(me)) & (F.col("post_type_id") == 2))
         .select(F.col("id").alias("aid"), "parent_id"))
    q = (posts.where(F.col("accepted_answer_id").isNotNull())
         .select(F.col("id").alias("qid"), "accepted_answer_id"))
    # one pass: every answer once (left join on the unique question key),
    # the accepted ones counted by the matched side
    j = a.join(q, (a["parent_id"] == q["qid"]) & (q["accepted_answer_id"] == a["aid"]), "left")
    g = j.agg(F.count("qid").alias("acc"), F.count(F.lit(1)).alias("total"))
    value = F.col("acc").cast("double") / F.col("total").cast("double") * F.lit(100.0)
    if safe:
        value = F.when(F.col("total") == 0, F.lit(None).cast("double")).otherwise(value)
    else:
        value = fail_if(F.col("total") == 0, value, "division by zero")
    return g.select(value.alias("accepted_percentage"))


def q08_rival_comparison(posts: DataFrame, me: int = 15811, rival: int = 449) -> DataFrame:
    """Every pair (my answer, rival post) under the same question."""
    mine = (posts.where((F.col("owner_user_id") == F.lit(me)) & (F.col("post_type_id") == 2))
            .select(F.col("parent_id").alias("question"), F.col("score").alias("my_score")))
    theirs = (posts.where(F.col("owner_user_id") == F.lit(rival))
              .select(F.col("parent_id").alias("r_parent"), F.col("score").alias("rival_score")))
    j = mine.join(theirs, mine["question"] == theirs["r_parent"])
    winner = (F.when(F.col("my_score") > F.col("rival_score"), "You win")
              .when(F.col("my_score") < F.col("rival_score"), "Rival wins")
              .otherwise("Tie"))
    return j.select(winner.alias("winner"), "question", "my_score", "rival_score")


def q10_top_answerers(posts: DataFrame, users: DataFrame, min_answers: int = 10,
                      limit: int = 500) -> DataFrame:
    """Users with more than ``min_answers`` open answers, by average score."""
    per_user = (posts.where((F.col("post_type_id") == 2)
                            & F.col("community_owned_date").isNull()
                            & F.col("closed_date").isNull())
                .groupBy(F.col("owner_user_id").alias("user_id"))
                .agg(F.count("id").alias("answers"),
                     F.sum("score").alias("_s"), F.count("score").alias("_c"))
                .where(F.col("answers") > min_answers))
    # avg(score)::numeric(6,2): rounded half away from zero, sorted on that
    avg = rounded_ratio(F.col("_s"), F.nullif(F.col("_c"), F.lit(0)), 2)
    return (per_user.join(_user_ids(users), "user_id")
            .select("user_id", "answers", avg.alias("avg_score"))
            .orderBy(F.desc_nulls_first("avg_score"), F.asc("user_id")).limit(limit))


def q15_best_accept_rate(posts: DataFrame, users: DataFrame, min_answers: int = 50,
                         limit: int = 100) -> DataFrame:
    """Accept rate of users' posts that have a parent, own questions excluded."""
    a = (posts.where(F.col("parent_id").isNotNull() & F.col("owner_user_id").isNotNull())
         .select(F.col("id").alias("aid"), "parent_id", F.col("owner_user_id").alias("user_id")))
    q = posts.select(F.col("id").alias("qid"), F.col("owner_user_id").alias("q_owner"),
                     "accepted_answer_id")
    j = (a.join(q, a["parent_id"] == q["qid"])
         .where((F.col("q_owner") != F.col("user_id")) | F.col("q_owner").isNull()))
    g = (j.groupBy("user_id")
         .agg(F.count(F.lit(1)).alias("num_answers"),
              F.count_if(F.col("accepted_answer_id") == F.col("aid")).alias("num_accepted"))
         .where(F.col("num_answers") >= min_answers))
    return (g.join(_user_ids(users), "user_id")
            .select("user_id", "num_answers", "num_accepted",
                    ratio(F.col("num_accepted") * 100, F.col("num_answers")).alias("accepted_pct"))
            .orderBy(F.desc("accepted_pct"), F.desc("num_answers"), F.asc("user_id"))
            .limit(limit))


def q20_thank_you(posts: DataFrame, pattern: str = "%hank%", max_len: int = 200,
                  min_count: int = 1) -> DataFrame:
    """Questions with more than ``min_count`` short thank-you answers."""
    return (posts.where((F.col("post_type_id") == 2)
                        & (F.length("body") <= max_len)
                        & F.col("body").ilike(pattern))
            .groupBy(F.col("parent_id").alias("question_id"))
            .agg(F.count(F.lit(1)).alias("thank_you_answers"))
            .where(F.col("thank_you_answers") > min_count)
            .orderBy(F.desc("thank_you_answers"), F.asc_nulls_last("question_id")))


def q23_unsung_heroes(posts: DataFrame, users: DataFrame, min_zero: int = 10) -> DataFrame:
    """Answerers whose accepted answers are mostly zero-scored."""
    q = (posts.where(F.col("accepted_answer_id").isNotNull())
         .select("accepted_answer_id", F.col("owner_user_id").alias("q_owner")))
    a = (posts.where(F.col("community_owned_date").isNull() & F.col("owner_user_id").isNotNull())
         .select(F.col("id").alias("aid"), F.col("owner_user_id").alias("user_id"), "score"))
    j = (q.join(a, q["accepted_answer_id"] == a["aid"])
         .where(F.col("user_id") != F.coalesce(F.col("q_owner"), F.lit(-1))))
    g = (j.groupBy("user_id")
         .agg(F.count_if(F.col("score") != 0).alias("non_zero_answers"),
              F.count_if(F.col("score") == 0).alias("zero_answers"))
         .where(F.col("zero_answers") > min_zero))
    rep = users.select(F.col("id").alias("user_id"), "reputation")
    frac = ratio(F.col("zero_answers"), F.col("zero_answers") + F.col("non_zero_answers"))
    return (g.join(rep, "user_id")
            .orderBy(F.desc_nulls_first(frac), F.asc("user_id"))
            .select("user_id", "non_zero_answers", "zero_answers", "reputation"))


def q32_highlander(posts: DataFrame, min_score: int = 5, min_question_score: int = 3,
                   limit: int = 25) -> DataFrame:
    """High-scoring sole, accepted answers to well-scored questions."""
    a = (posts.where((F.col("post_type_id") == 2) & (F.col("score") > min_score))
         .select(F.col("owner_user_id").alias("user_id"), F.col("id").alias("post_id"),
                 "score", "parent_id"))
    q = (posts.where((F.col("score") > min_question_score) & (F.col("answer_count") == 1))
         .select(F.col("id").alias("qid"), "accepted_answer_id"))
    j = a.join(q, (q["qid"] == a["parent_id"]) & (q["accepted_answer_id"] == a["post_id"]))
    return (j.select("user_id", "post_id", "score")
            .orderBy(F.desc("score"), F.asc("post_id")).limit(limit))


def q34_self_accept(posts: DataFrame, users: DataFrame, min_self: int = 10,
                    limit: int = 100) -> DataFrame:
    """Share of a user's questions that accepted the user's own answer."""
    q = (posts.where(F.col("accepted_answer_id").isNotNull() & F.col("owner_user_id").isNotNull())
         .select("accepted_answer_id", F.col("owner_user_id").alias("user_id")))
    a = (posts.where(F.col("owner_user_id").isNotNull())
         .select(F.col("id").alias("aid"), F.col("owner_user_id").alias("a_owner")))
    sa = (q.join(a, q["accepted_answer_id"] == a["aid"])
          .where(F.col("user_id") == F.col("a_owner"))
          .groupBy("user_id").agg(F.count(F.lit(1)).alias("self_accepts"))
          .where(F.col("self_accepts") > min_self))
    qc = (posts.where(F.col("post_type_id") == 1)
          .groupBy(F.col("owner_user_id").alias("user_id"))
          .agg(F.count(F.lit(1)).alias("questions")))
    pct = rounded_ratio(F.col("self_accepts") * 100, F.col("questions"), 2)
    return (sa.join(qc, "user_id").join(_user_ids(users), "user_id")
            .select("user_id", pct.alias("self_answer_pct"))
            .orderBy(F.desc("self_answer_pct"), F.asc("user_id")).limit(limit))
