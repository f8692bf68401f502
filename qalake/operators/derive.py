"""The derived post-to-tag relation (D1-D3).

``posts.tags`` holds ``|a|b|c|``; the relation has one row per (post, known
tag). Posts with NULL or empty tags and names missing from ``tags`` vanish.
The explode is narrow (no shuffle); the join with the tag dimension is left to
AQE, which broadcasts it when its measured size is under the threshold and
sort-merges otherwise - the tag list is not assumed to be small.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import paths
from ..session import scratch_path
from ..sources import fingerprint
from . import snapshots, staging


def post_tags(posts: DataFrame, tags: DataFrame) -> DataFrame:
    """(post_id int, tag_id int, tag_name str) for every tag of every post."""
    exploded = (posts
                .where(F.col("tags").isNotNull() & (F.col("tags") != ""))
                .select(F.col("id").alias("post_id"),
                        F.explode(F.split(F.btrim(F.col("tags"), F.lit("|")), r"[|]"))
                        .alias("tag_name")))
    dim = tags.select(F.col("id").alias("tag_id"), F.col("tag_name"))
    return exploded.join(dim, "tag_name").select("post_id", "tag_id", "tag_name")


def post_tags_duplicates(pt: DataFrame) -> DataFrame:
    """(post_id, tag_id, n) pairs that occur more than once (D2).

    The reference's unique index turns any such pair into an error; here the
    offenders are returned so the caller can fail or inspect them.
    """
    return (pt.groupBy("post_id", "tag_id").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 1))


def check_post_tags_unique(pt: DataFrame) -> None:
    """Raise when (post_id, tag_id) is not unique (D2)."""
    bad = post_tags_duplicates(pt).limit(5).collect()
    if bad:
        pairs = ", ".join(f"({r.post_id}, {r.tag_id})" for r in bad)
        raise ValueError(f"post_tags has duplicate (post_id, tag_id) pairs: {pairs}")


def refresh_post_tags(spark: SparkSession, posts: DataFrame, tags: DataFrame,
                      table: str, path: str | None = None,
                      check_unique: bool = True) -> DataFrame:
    """Recompute and store the relation (D3: the materialized view refresh).

    The rows of a post lie together and sorted in the files (joins on post_id
    still shuffle). An overwrite drops the old files before the new ones are
    committed, so readers must not rely on the table while it is refreshed.
    """
    pt = post_tags(posts, tags)
    if check_unique:
        check_post_tags_unique(pt)
    writer = (pt.repartition("post_id").sortWithinPartitions("post_id")
              .write.mode("overwrite").format("parquet"))
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    spark.catalog.refreshTable(table)
    return spark.table(table)


#: Post ids of a span: what is rewritten when one of its posts changes.
SPAN_POSTS = 1 << 16
#: Folders of a relation, about: of more spans, neighbours share a folder.
FOLDERS, LAYOUT = 1024, "spans_per_folder"


@dataclass(frozen=True)
class Maintained:
    relation: DataFrame
    spans: list[int]           # spans that were rewritten (of a folder of several spans, the first)


def _tag_names(posts: DataFrame) -> DataFrame:
    """(span, tag_name) of the posts' tags."""
    return posts.where("tags is not null and tags <> ''").select(
        "span", F.explode(F.split(F.btrim(F.col("tags"), F.lit("|")), r"[|]")).alias("tag_name"))


def _first_span(rows: DataFrame, per_folder: int) -> DataFrame:
    """The rows with ``span`` replaced by the first span of its folder."""
    if per_folder == 1:
        return rows
    span = F.col("span")
    return rows.withColumn("span", F.when(span == fingerprint.LOOSE, span).otherwise(span - F.pmod(span, F.lit(per_folder))))


def _spans_per_folder(spark: SparkSession, before: snapshots.Snapshot | None) -> int | None:
    """How the stored relation is laid out; None if there is none."""
    if before is None:
        return None
    layout = f"{before.path}/{LAYOUT}"
    return int(paths.read_text(spark, layout)) if paths.exists(spark, layout) else 1


def maintain_post_tags(spark: SparkSession, posts: DataFrame, tags: DataFrame, path: str, *, width: int = SPAN_POSTS,
                       check_unique: bool = True) -> Maintained:
    """Bring the stored relation below ``path`` up to date, rewriting only what changed (D3).

    The relation lies in one folder per span of ``width`` post ids; of more than ``FOLDERS``
    spans, neighbours share a folder, so that files grow with rows and not with spans. What it
    was made from is kept beside it: a fingerprint of the posts' ids and tags, one hash per
    span, and the tags. Spans whose hash differs, and spans with posts of a tag that came, went
    or changed its id, are computed anew and replace their folders; all other files stay as they
    are. The state is committed last: a stop in between makes the next call do the same spans
    again. At most one number per folder reaches the driver. A relation whose spans have
    outgrown their folders fourfold is laid out anew.
    """
    root, state = f"{path.rstrip('/')}/relation", f"{path.rstrip('/')}/_state"
    posts = posts.select("id", "tags").withColumn("span", fingerprint.piece_of(F.col("id"), width))
    tags = tags.select("id", "tag_name")
    before = snapshots.newest(spark, state)
    done: list[int] = []

    def bring_up_to_date(folder: str) -> None:
        tree = f"{folder}/tree"
        fingerprint.write_tree(fingerprint.row_pieces(posts, F.col("id"), [F.col("id"), F.col("tags")], width), tree)
        tags.write.parquet(f"{folder}/tags")
        spans = spark.read.schema(fingerprint.NODE_SCHEMA).parquet(f"{tree}/level=0").select(F.col("node").alias("span"))
        fitting = -(-spans.count() // FOLDERS) or 1
        per_folder = _spans_per_folder(spark, before)
        if per_folder is None or fitting > 4 * per_folder:
            per_folder = fitting
            paths.delete(spark, root)  # a first try, or another layout, may have left something
            touched = spans
        else:
            touched = fingerprint.changed_pieces(spark, f"{before.path}/tree", tree).select(F.col("piece").alias("span"))
            old = spark.read.schema(tags.schema).parquet(f"{before.path}/tags")
            names = tags.exceptAll(old).unionAll(old.exceptAll(tags)).select("tag_name").distinct()
            if names.limit(1).count():
                touched = touched.unionAll(_tag_names(posts).join(names, "tag_name", "left_semi").select("span"))
        paths.write_text(spark, f"{folder}/{LAYOUT}", str(per_folder))
        done.extend(sorted(r["span"] for r in _first_span(touched, per_folder).distinct().collect()))
        if not done:
            return
        only = F.broadcast(spark.createDataFrame([(k,) for k in done], "span long"))  # one row per folder
        rows = post_tags(_first_span(posts, per_folder).join(only, "span", "left_semi"), tags)
        rows = _first_span(rows.withColumn("span", fingerprint.piece_of(F.col("post_id"), width)), per_folder)
        made = scratch_path(spark, "post-tags-rows")  # computed once, for the check and the files
        rows.write.parquet(made)
        rows = spark.read.schema(rows.schema).parquet(made)
        if check_unique:
            check_post_tags_unique(rows)
        with staging.session_settings(spark, {"spark.sql.sources.partitionOverwriteMode": "dynamic"}):
            rows.repartition("span").sortWithinPartitions("span", "post_id").write.mode("overwrite").partitionBy("span").parquet(root)
        written = {r["span"] for r in rows.select("span").distinct().collect()}
        for k in set(done) - written:  # spans whose posts have lost all tags
            paths.delete(spark, f"{root}/span={k}")
        paths.delete(spark, made)

    snapshots.write(spark, state, bring_up_to_date)
    schema = "post_id int, tag_id int, tag_name string"
    if not paths.exists(spark, root):
        return Maintained(spark.createDataFrame([], schema), done)
    return Maintained(spark.read.schema(schema).parquet(root).select("post_id", "tag_id", "tag_name"), done)
