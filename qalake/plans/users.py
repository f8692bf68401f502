"""User-level analytics: q06, q13, q22, q25, q35."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.pg import days_between, fail_if, idiv, ratio, rounded_ratio


def q06_rank_percentile(users: DataFrame, me: int = 15811, floor: int = 100) -> DataFrame:
    """My rank by reputation and that rank over the users above ``floor``.

    My reputation is a scalar subquery (one row by the key); the two counts
    are conditional counts of ONE pass over the users, another scalar.
    """
    mine = users.where(F.col("id") == F.lit(me))
    my_rep = mine.select("reputation").scalar()
    counts = users.agg(F.struct(
        F.count_if(F.col("reputation") > my_rep).alias("above"),
        F.count_if(F.col("reputation") > F.lit(floor)).alias("base"))).scalar()
    ranking = counts["above"] + F.lit(1)
    pct = fail_if(counts["base"] == 0, ratio(ranking, counts["base"]), "division by zero")
    return mine.select("id", ranking.alias("ranking"), pct.alias("percentile"))


def q13_high_standards(users: DataFrame, min_rep: int = 1000, min_upvotes: int = 10,
                       limit: int = 100) -> DataFrame:
    """High-reputation users who cast few up-votes."""
    u = users.where((F.col("reputation") > min_rep) & (F.col("up_votes") > min_upvotes))
    # round(100.0 * (reputation / 10) / (up_votes + 1), 2); the inner / is integer
    pct = rounded_ratio(idiv(F.col("reputation"), F.lit(10)) * 100, F.col("up_votes") + 1, 2)
    return (u.select(F.col("id").alias("user_id"), pct.alias("ratio_pct"),
                     "reputation", "up_votes", "down_votes")
            .orderBy(F.desc("ratio_pct"), F.asc("user_id")).limit(limit))


def _percent_as_fraction(percent) -> tuple[int, int]:
    """percent -> (integer numerator, power of ten) so that p = n / 10**s."""
    d = Decimal(str(percent))
    s = max(0, -d.as_tuple().exponent)
    return int(d.scaleb(s)), s


def q22_elite_users(users: DataFrame, percent=10, id_bucket: int = 1 << 16) -> DataFrame:
    """The user at which the running reputation (highest first, then id)
    reaches ``percent`` % of all reputation, with the total and the rank.

    A global running window would put every user into one task. Instead:
    (1) aggregate per distinct reputation value and run the prefix sum over
    those values only (one small task: the distinct values, not the users);
    (2) the cut-off value v and the position k inside it follow by integer
    arithmetic; (3) the k-th smallest id among users with reputation v is found
    through id buckets: per-bucket counts (small), their prefix sum, and a
    row_number inside the single bucket that holds position k (at most
    ``id_bucket`` rows). NULL reputations sort first (Postgres DESC) and only
    add to the rank. Reputations are taken as non-negative, as in the dumps.
    """
    pct_n, s = _percent_as_fraction(percent)
    scale = 100 * 10 ** s  # running * scale >= total * pct_n  <=>  running >= total * p / 100
    base = users.select("id", "display_name", "reputation")
    rep = F.col("reputation")
    # one row per distinct reputation (the NULL group included): the only
    # input of the un-partitioned windows below
    per_value = base.groupBy("reputation").agg(F.count(F.lit(1)).alias("n"),
                                                 F.sum(rep.cast("long")).alias("s"))
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    running = (Window.orderBy(F.desc_nulls_last("reputation"))
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    cum = (per_value
           .withColumn("total", F.sum("s").over(everything))
           .withColumn("n_null", F.sum(F.when(rep.isNull(), F.col("n")).otherwise(0)).over(everything))
           .withColumn("cum_end", F.sum("s").over(running))
           .withColumn("users_before", F.sum("n").over(running) - F.col("n"))
           .where(rep.isNotNull() & (F.col("cum_end") * F.lit(scale) >= F.col("total") * F.lit(pct_n)))
           .orderBy(F.desc("reputation")).limit(1))
    need = F.col("total") * F.lit(pct_n) - (F.col("cum_end") - F.col("s")) * F.lit(scale)
    step = rep.cast("long") * F.lit(scale)
    k = F.when((need <= 0) | (step <= 0), F.lit(1)).otherwise(idiv(need + step - F.lit(1), step))
    cut = cum.select(rep.alias("cut_rep"), k.alias("k"), "users_before", "n_null", "total")
    # users with the cut-off reputation, positioned by id through buckets;
    # ``cut`` is one row (LIMIT 1), so broadcasting it is bounded
    tied = (base.join(F.broadcast(cut), rep == F.col("cut_rep"))
            .withColumn("bucket", idiv(F.col("id"), F.lit(id_bucket))))
    per_bucket = tied.groupBy("bucket", "k").agg(F.count(F.lit(1)).alias("bn"))
    wb = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    spans = (per_bucket.withColumn("before", F.sum("bn").over(wb) - F.col("bn"))
             .where((F.col("before") < F.col("k")) & (F.col("k") <= F.col("before") + F.col("bn")))
             .select("bucket", "before"))
    wi = Window.partitionBy("bucket").orderBy("id")
    pick = (tied.join(F.broadcast(spans), "bucket")  # spans: the one bucket holding position k
            .withColumn("pos", F.row_number().over(wi) + F.col("before"))
            .where(F.col("pos") == F.col("k")))
    return pick.select(
        F.col("reputation").alias("cutoff_reputation"),
        F.col("id").alias("cutoff_id"),
        F.col("display_name").alias("cutoff_name"),
        F.col("total").alias("total_reputation"),
        (F.col("n_null") + F.col("users_before") + F.col("k")).cast("long").alias("number_of_users"))


def q25_rising_stars(users: DataFrame, posts: DataFrame, min_rep: int = 5000,
                     limit: int = 50, safe: bool = False) -> DataFrame:
    """Reputation per day since joining, up to the dump's last post."""
    end = posts.agg(F.max("creation_date")).scalar()
    u = users.where(F.col("reputation") > min_rep).withColumn("end_date", end)
    days = days_between(F.col("end_date"), F.col("creation_date"))
    per_day = idiv(F.col("reputation"), F.nullif(days, F.lit(0)) if safe else days)
    if not safe:
        per_day = fail_if(days == 0, per_day, "division by zero")
    return (u.select(F.col("id").alias("user_id"), "reputation", days.alias("days"),
                     per_day.cast("int").alias("rep_per_day"))
            .orderBy(F.desc_nulls_first("rep_per_day"), F.asc("user_id")).limit(limit))


def q35_popular_question_ratio(badges: DataFrame, posts: DataFrame, users: DataFrame,
                               badge: str = "Popular Question", min_badges: int = 10,
                               limit: int = 100) -> DataFrame:
    """Users with many 'Popular Question' badges over their question count."""
    pb = (badges.where(F.col("name") == F.lit(badge))
          .groupBy("user_id").agg(F.count(F.lit(1)).alias("popular_questions"))
          .where(F.col("popular_questions") >= min_badges))
    qc = (posts.where(F.col("post_type_id") == 1)
          .groupBy(F.col("owner_user_id").alias("user_id"))
          .agg(F.count(F.lit(1)).alias("total_questions")))
    uid = users.select(F.col("id").alias("user_id"))
    return (pb.join(qc, "user_id").join(uid, "user_id")
            .select("user_id", "popular_questions", "total_questions",
                    rounded_ratio(F.col("popular_questions"), F.col("total_questions"), 4)
                    .alias("ratio"))
            .orderBy(F.desc("ratio"), F.asc("user_id")).limit(limit))
