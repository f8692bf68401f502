"""Content analytics: q03, q11, q12, q24, q30, q33."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.pg import days_between


def q03_comment_scores(comments: DataFrame, me: int = 15811) -> DataFrame:
    """How many of my comments have each score."""
    return (comments.where(F.col("user_id") == F.lit(me))
            .groupBy("score").agg(F.count(F.lit(1)).alias("comment_count"))
            .select("comment_count", "score")
            .orderBy(F.desc_nulls_first("score")))


def q11_top_editors(posts: DataFrame, users: DataFrame, limit: int = 50) -> DataFrame:
    """Last editors other than the owner, by number of edited posts."""
    edits = (posts.where(F.col("last_editor_user_id").isNotNull()
                         & (F.col("last_editor_user_id") != F.col("owner_user_id")))
             .groupBy(F.col("last_editor_user_id").alias("user_id"))
             .agg(F.count_if(F.col("post_type_id") == 1).alias("question_edits"),
                  F.count_if(F.col("post_type_id") == 2).alias("answer_edits"),
                  F.count(F.lit(1)).alias("total_edits")))
    uid = users.select(F.col("id").alias("user_id"))
    return (edits.join(uid, "user_id")
            .select("user_id", "question_edits", "answer_edits", "total_edits")
            .orderBy(F.desc("total_edits"), F.asc("user_id")).limit(limit))


def q12_low_view_unanswered(posts: DataFrame, min_score: int = 2, min_views: int = 0,
                            limit: int = 500) -> DataFrame:
    """Well-scored questions without an accepted answer, fewest views first."""
    return (posts.where((F.col("score") > min_score) & (F.col("view_count") > min_views)
                        & F.col("parent_id").isNull() & F.col("accepted_answer_id").isNull())
            .select(F.col("id").alias("post_id"), "score", "view_count")
            .orderBy(F.asc("view_count"), F.asc("post_id")).limit(limit))


def q24_quickest_badge(badges: DataFrame, users: DataFrame, badge: str = "Guru") -> DataFrame:
    """Days from joining to winning ``badge``, and since its first award."""
    b = badges.where(F.col("name") == F.lit(badge)).select("user_id", "date")
    first = b.agg(F.min(F.to_date("date"))).scalar()  # over all holders, known users or not
    members = users.select(F.col("id").alias("uid"), F.col("creation_date").alias("member_since"))
    e = b.join(members, b["user_id"] == members["uid"]).withColumn("first_time", first)
    return (e.select("user_id", "member_since", F.col("date").alias("date_won"),
                     (days_between(F.col("date"), F.col("member_since")) + 1).alias("days_membership"),
                     F.datediff(F.to_date("date"), F.col("first_time")).alias("days_since_first"))
            .orderBy(F.asc_nulls_last("days_membership"), F.asc("user_id"), F.asc("date_won")))


def _like_literal_is_plain(site: str) -> str | None:
    """The literal text a LIKE pattern ``site`` (escape ``!``) stands for,
    or None if it holds a wildcard."""
    out, i = [], 0
    while i < len(site):
        ch = site[i]
        if ch == "!" and i + 1 == len(site):
            return None  # it escapes the wildcard behind the site
        if ch == "!":
            out.append(site[i + 1])
            i += 2
            continue
        if ch in "%_":
            return None
        out.append(ch)
        i += 1
    return "".join(out)


def q30_vanity_search(users: DataFrame, posts: DataFrame, comments: DataFrame,
                      me: int = 30633, months: int = 2) -> DataFrame:
    """Posts and comments by others naming my website in the last months.

    "Now" is the dump's end: the later of the last post activity and the last
    comment. The site is used as a LIKE pattern with escape ``!``.

    The site and the window start are one row (bounded by the users key),
    fetched first like a psql ``\\gset``: as literals, the date bound is
    pushed into the parquet scans (row groups outside the window are skipped)
    and a site without wildcards is a plain substring test. Each big text
    column is then scanned once.
    """
    spark = posts.sparkSession
    site = F.rtrim(F.regexp_replace(F.col("website_url"), r"^https?://", ""), F.lit("/"))
    mine = users.where(F.col("id") == F.lit(me)).select(site.alias("site"))
    end = F.greatest(posts.agg(F.max("last_activity_date")).scalar(),
                     comments.agg(F.max("creation_date")).scalar())
    since = (end - F.make_ym_interval(F.lit(0), F.lit(months))).alias("since")
    rows = (mine.where(F.col("site") != "").select("site", since)
            .where(F.col("since").isNotNull()).collect())
    out_schema = "post_id int, last_activity timestamp_ntz"
    if not rows:
        return spark.createDataFrame([], out_schema)
    hits = None
    for r in rows:  # one row per user with this id (the key): normally exactly one
        plain = _like_literal_is_plain(r["site"])
        pattern = _pg_like_to_spark("%" + r["site"] + "%")
        # a zone-free literal: the text of the NTZ value
        since = F.lit(r["since"].isoformat(sep=" ")).cast("timestamp_ntz")

        def names(c: str) -> Column:
            if plain is not None:
                return F.instr(F.col(c), plain) > 0
            return F.col(c).like(pattern)

        in_posts = (posts.where((F.col("last_activity_date") >= since)
                                & (F.col("owner_user_id") != F.lit(me)) & names("body"))
                    .select(F.col("id").alias("pid")))
        in_comments = (comments.where((F.col("creation_date") >= since)
                                      & (F.col("user_id") != F.lit(me)) & names("text"))
                       .select(F.col("post_id").alias("pid")))
        part = in_posts.union(in_comments)
        hits = part if hits is None else hits.union(part)
    hits = hits.distinct()
    p = posts.select(F.col("id").alias("post_id"), F.col("last_activity_date").alias("last_activity"))
    return (hits.join(p, hits["pid"] == p["post_id"])
            .select("post_id", "last_activity")
            .orderBy(F.desc_nulls_first("last_activity"), F.asc("post_id")))


def _pg_like_to_spark(site: str) -> str:
    """Postgres LIKE pattern with escape '!' -> Spark pattern with escape '\\'.

    '!%' and '!_' are literal wildcards, '!x' is a literal x for any other x;
    a pattern ending in a lone '!' is an error, as in Postgres.
    """
    out, i = [], 0
    while i < len(site):
        ch = site[i]
        if ch == "!":
            if i + 1 >= len(site):
                raise ValueError("LIKE pattern must not end with escape character")
            nxt = site[i + 1]
            out.append("\\" + nxt if nxt in "%_\\" else nxt)
            i += 2
            continue
        out.append("\\\\" if ch == "\\" else ch)
        i += 1
    return "".join(out)


def q33_short_titles(posts: DataFrame, max_len: int = 16) -> DataFrame:
    """Questions whose title is shorter than ``max_len`` characters."""
    return (posts.where((F.length("title") < max_len) & F.col("parent_id").isNull())
            .select(F.col("id").alias("post_id"), "body", "score"))
