"""Time and tag-trend analytics: q16, q18."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.pg import idiv

_MICROS_PER_DAY = 86_400_000_000


def q16_monthly_totals(posts: DataFrame, buckets: int = 12, days: int = 30) -> DataFrame:
    """Questions and answers in ``buckets`` windows of ``days`` days, counted
    back from the creation date of the post with the largest id.

    Both bounds of a window are inclusive, so a post exactly on a bound counts
    in two windows. Instead of a range join (nested loop) every post computes
    the one or two window numbers it falls in: d = end - ts; b = d div W + 1,
    and also b - 1 when d is a positive multiple of W. One pass, one tiny
    aggregate, joined to the fixed list of windows.
    """
    spark = posts.sparkSession
    newest = posts.agg(F.max_by("creation_date", "id")).scalar()
    width = days * _MICROS_PER_DAY
    d = F.timestamp_diff("MICROSECOND", F.col("creation_date"), newest)
    oldest = newest - F.make_dt_interval(F.lit(buckets * days))  # a plain bound, which reaches the scan
    p = (posts.where((F.col("creation_date") >= oldest) & (F.col("creation_date") <= newest))
         .select("creation_date", F.col("parent_id").isNull().alias("is_q"))
         .select("is_q", d.alias("d"))
         .where((F.col("d") >= 0) & (F.col("d") <= F.lit(buckets * width))))
    first = idiv(F.col("d"), F.lit(width)) + 1
    on_bound = (F.col("d") > 0) & (F.col("d") % F.lit(width) == 0)
    hits = (p.select("is_q", F.explode(F.array(first, F.when(on_bound, first - 1))).alias("bucket"))
            .where(F.col("bucket").between(1, buckets))
            .groupBy("bucket")
            .agg(F.count_if(F.col("is_q")).alias("q"), F.count_if(~F.col("is_q")).alias("a")))
    frame = (spark.range(1, buckets + 1).select(F.col("id").alias("bucket"))
             .select("bucket", (newest - F.make_dt_interval(F.col("bucket") * days)).alias("start")))
    return (frame.join(hits, "bucket", "left")
            .select("start", F.coalesce("q", F.lit(0)).cast("long").alias("total_questions"),
                    F.coalesce("a", F.lit(0)).cast("long").alias("total_answers"))
            .orderBy(F.desc_nulls_first("start")))


def q18_tags_in_month(posts: DataFrame, post_tags: DataFrame, start: str = "2010-05-01",
                      end: str = "2010-06-01", min_total: int = 800) -> DataFrame:
    """Tags with more than ``min_total`` posts: their count in [start, end),
    ranked by that and by the total count.

    The two row_numbers run over the per-tag aggregate (one row per tag), so
    the un-partitioned window sees a tag list, never the posts.
    """
    lo = F.lit(start).cast("timestamp_ntz")
    hi = F.lit(end).cast("timestamp_ntz")
    in_month = posts.where((F.col("creation_date") >= lo) & (F.col("creation_date") < hi)).select("id")
    month = (post_tags.join(in_month, post_tags["post_id"] == in_month["id"])
             .groupBy("tag_name").agg(F.count(F.lit(1)).alias("month_count")))
    total = (post_tags.groupBy("tag_name").agg(F.count(F.lit(1)).alias("total_count"))
             .where(F.col("total_count") > min_total))
    j = month.join(total, "tag_name")
    w_month = Window.orderBy(F.desc("month_count"), F.asc("tag_name"))
    w_total = Window.orderBy(F.desc("total_count"), F.asc("tag_name"))
    return (j.select("tag_name",
                     F.row_number().over(w_month).alias("month_rank"),
                     F.row_number().over(w_total).alias("total_rank"),
                     "month_count", "total_count")
            .orderBy(F.desc("month_count"), F.asc("tag_name")))
