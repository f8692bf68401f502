"""Run an analytic by its number against a loaded site, like running one of
the explorer SQL files against a loaded database.

    run_query(spark, "mysite", "q09")                 # defaults
    run_query(spark, "mysite", "q01", me=15811)       # parameters as keywords

The site's tables are the catalog tables written by the pipeline
(``<site>.posts`` ...). ``post_tags`` is read from ``<site>.post_tags`` when it
was stored (``operators.derive.refresh_post_tags``), else derived on the fly.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .operators.derive import post_tags
from .plans import answers, content, timeline, users, votes

# number -> (function, the tables it takes, in order)
ANALYTICS: dict[str, tuple[Callable[..., DataFrame], tuple[str, ...]]] = {
    "q01": (votes.q01_upvotes_per_tag, ("posts", "post_tags", "votes")),
    "q02": (answers.q02_unsung, ("posts",)),
    "q03": (content.q03_comment_scores, ("comments",)),
    "q04": (votes.q04_interesting_unanswered, ("posts", "post_tags", "votes", "users")),
    "q05": (answers.q05_accept_rate, ("posts",)),
    "q06": (users.q06_rank_percentile, ("users",)),
    "q07": (votes.q07_passive_reputation, ("posts", "votes")),
    "q08": (answers.q08_rival_comparison, ("posts",)),
    "q09": (votes.q09_controversial, ("posts", "votes")),
    "q10": (answers.q10_top_answerers, ("posts", "users")),
    "q11": (content.q11_top_editors, ("posts", "users")),
    "q12": (content.q12_low_view_unanswered, ("posts",)),
    "q13": (users.q13_high_standards, ("users",)),
    "q14": (votes.q14_tag_badge_progress, ("posts", "post_tags", "votes")),
    "q15": (answers.q15_best_accept_rate, ("posts", "users")),
    "q16": (timeline.q16_monthly_totals, ("posts",)),
    "q18": (timeline.q18_tags_in_month, ("posts", "post_tags")),
    "q19": (votes.q19_dangerous_tags, ("posts", "post_tags", "votes", "tags")),
    "q20": (answers.q20_thank_you, ("posts",)),
    "q22": (users.q22_elite_users, ("users",)),
    "q23": (answers.q23_unsung_heroes, ("posts", "users")),
    "q24": (content.q24_quickest_badge, ("badges", "users")),
    "q25": (users.q25_rising_stars, ("users", "posts")),
    "q26": (votes.q26_bounties_won, ("posts", "votes")),
    "q27": (votes.q27_votes_by_weekday, ("posts", "votes")),
    "q29": (votes.q29_bounties_by_month, ("posts", "votes")),
    "q30": (content.q30_vanity_search, ("users", "posts", "comments")),
    "q32": (answers.q32_highlander, ("posts",)),
    "q33": (content.q33_short_titles, ("posts",)),
    "q34": (answers.q34_self_accept, ("posts", "users")),
    "q35": (users.q35_popular_question_ratio, ("badges", "posts", "users")),
}


def site_table(spark: SparkSession, site: str, name: str) -> DataFrame:
    if name == "post_tags":
        if spark.catalog.tableExists(f"{site}.post_tags"):
            return spark.table(f"{site}.post_tags")
        return post_tags(spark.table(f"{site}.posts"), spark.table(f"{site}.tags"))
    return spark.table(f"{site}.{name}")


def run_query(spark: SparkSession, site: str, number: str, **params) -> DataFrame:
    """The analytic ``number`` ('q09' or '9') over the site's tables."""
    key = f"q{int(str(number).lstrip('qQ')):02d}"
    if key not in ANALYTICS:
        raise KeyError(f"no analytic {number}; known: {', '.join(ANALYTICS)}")
    fn, names = ANALYTICS[key]
    return fn(*[site_table(spark, site, n) for n in names], **params)
