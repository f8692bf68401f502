"""Registered checks of the ingestion operators (S1-S18, D2).

Each callable renders rows of the adapter tables as dump lines (or parts)
into a fresh folder below the session's shared checkpoint directory, runs the
operator on them and returns the result; the oracle is SQL over the same
adapter text. All of it grows with the input tables.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import adapter, paths
from .adapter import oracle
from .operators import derive, snapshots, staging, tables
from .operators.key_index import KeyIndex
from .operators.quarantine import quarantine
from .pipeline import PipelineArgs, run_pipeline, staged_manifest
from .functions.pg import idiv
from .session import scratch_path
from .sources import dump, files, fingerprint, pieces
from .specs import spec
from .streaming.ingest import ingest_stream

POST_ATTRS = {
    "id": "Id", "post_type_id": "PostTypeId", "accepted_answer_id": "AcceptedAnswerId",
    "parent_id": "ParentId", "creation_date": "CreationDate", "score": "Score",
    "view_count": "ViewCount", "body": "Body", "owner_user_id": "OwnerUserId",
    "last_editor_user_id": "LastEditorUserId", "last_activity_date": "LastActivityDate",
    "title": "Title", "tags": "Tags", "answer_count": "AnswerCount",
    "closed_date": "ClosedDate", "community_owned_date": "CommunityOwnedDate",
}
USER_ATTRS = {"id": "Id", "reputation": "Reputation", "creation_date": "CreationDate",
              "display_name": "DisplayName", "website_url": "WebsiteUrl",
              "up_votes": "UpVotes", "down_votes": "DownVotes"}
VOTE_ATTRS = {"id": "Id", "post_id": "PostId", "vote_type_id": "VoteTypeId",
              "creation_date": "CreationDate", "user_id": "UserId", "bounty_amount": "BountyAmount"}
BADGE_ATTRS = {"id": "Id", "user_id": "UserId", "name": "Name", "date": "Date"}
COMMENT_ATTRS = {"id": "Id", "post_id": "PostId", "score": "Score", "text": "Text",
                 "creation_date": "CreationDate", "user_id": "UserId"}
TAG_ATTRS = {"id": "Id", "tag_name": "TagName"}
POST_COLS = list(POST_ATTRS)
DOC_COLS = ["doc_id", "text", "lang", "source", "n_chars"]


def _posts_dump(spark: SparkSession, sf: str, **kw) -> str:
    path = scratch_path(spark, "Posts.xml")
    return dump.write_dump(adapter.load(spark, sf).posts, path, POST_ATTRS, **kw)


def _typed_posts(spark: SparkSession, path: str, **kw) -> DataFrame:
    return dump.typed(dump.read_dump(spark, path, spec("posts"), **kw), spec("posts")).select(*POST_COLS)


def _lineitem_keys(spark: SparkSession, sf: str) -> DataFrame:
    """All-string rows keyed by l_orderkey*8+l_linenumber, some keys blank or
    not numbers (the key is not unique: surplus rows are duplicates)."""
    li = adapter.read_base(spark, sf, "lineitem")
    key = (F.when(F.col("l_partkey") % 97 == 0, F.lit(""))
           .when(F.col("l_partkey") % 89 == 0, F.concat(F.lit("k"), F.col("l_orderkey").cast("string")))
           .otherwise((F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("string")))
    return li.select(key.alias("id"), F.col("l_orderkey").cast("string").alias("order_key"),
                     F.col("l_linenumber").cast("string").alias("line"),
                     F.col("l_partkey").cast("string").alias("part_key"))


DUCK_LI_KEYS = """li AS (
SELECT CASE WHEN l_partkey % 97 = 0 THEN ''
            WHEN l_partkey % 89 = 0 THEN 'k' || CAST(l_orderkey AS VARCHAR)
            ELSE CAST(l_orderkey * 8 + l_linenumber AS VARCHAR) END AS id,
       CAST(l_orderkey AS VARCHAR) AS order_key, CAST(l_linenumber AS VARCHAR) AS line,
       CAST(l_partkey AS VARCHAR) AS part_key
FROM lineitem)"""

DUCK_POSTS_TYPED = "SELECT " + ", ".join(POST_COLS) + " FROM se_posts"


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return adapter.read_base(spark, sf, "documents").select(*DOC_COLS)


def _doc_types(df: DataFrame) -> DataFrame:
    return df.select(F.col("doc_id").cast("long"), "text", "lang", "source",
                     F.col("n_chars").cast("long"))


def _parts_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    out = scratch_path(spark, "documents-parts")
    staging.write_parts(_documents(spark, sf), out, "doc_id", shards=8, max_rows_per_part=200, fmt="csv")
    return _doc_types(staging.read_parts(spark, out, "csv")).select(*DOC_COLS)


def _manifest_load(spark: SparkSession, sf: str) -> DataFrame:
    out = scratch_path(spark, "documents-staged")
    staging.write_parts(_documents(spark, sf), out, "doc_id", shards=8, max_rows_per_part=200, fmt="csv")
    staging.build_manifest(spark, out, table="documents", key="doc_id", columns=DOC_COLS,
                           source="documents.parquet", shards=8, fmt="csv")
    return _doc_types(staging.load_manifest(spark, f"{out}/{staging.MANIFEST}", verify_rows=True))


def _manifest_counts(spark: SparkSession, sf: str) -> DataFrame:
    out = scratch_path(spark, "posts-staged")
    staging.write_parts(adapter.load(spark, sf).posts, out, "id", shards=8, max_rows_per_part=1000)
    staging.build_manifest(spark, out, table="posts", key="id", columns=POST_COLS, source="se_posts", shards=8)
    stored = spark.read.option("multiLine", True).json(f"{out}/{staging.MANIFEST}")
    shard = F.regexp_extract("part.path", "^shard=([0-9]+)/", 1).cast("int")
    return (stored.select(F.explode("parts").alias("part")).groupBy(shard.alias("shard"))
            .agg(F.sum("part.rows").alias("rows")))


def _append_vs_truncate(spark: SparkSession, sf: str) -> DataFrame:
    site = "qa_" + uuid.uuid4().hex[:10]
    tables.create_site(spark, site, scratch_path(spark, site + ".db"))
    sp = spec("votes")
    v = adapter.load(spark, sf).votes
    appended = tables.create_table(spark, sp, site)  # votes
    tables.save_table(v.where(F.col("id") % 2 == 0), spark, appended, key="id")
    tables.save_table(v.where(F.col("id") % 2 == 1), spark, appended, key="id")
    clash = 0
    try:
        tables.save_table(v.where(F.col("id") % 3 == 0), spark, appended, key="id")
    except ValueError:
        clash = 1
    repeat = 0
    new = v.where("id < 100").withColumn("id", F.col("id") - 1000)
    try:
        tables.save_table(new.unionAll(new), spark, appended, key="id")
    except ValueError:
        repeat = 1
    spark.sql(f"CREATE TABLE {site}.replaced LIKE {appended}")
    replaced = f"{site}.replaced"
    tables.save_table(v, spark, replaced, key="id")
    tables.save_table(v, spark, replaced, truncate_first=True, key="id")
    return (spark.table(appended).agg(F.count(F.lit(1)).alias("rows")).select(F.lit("append").alias("mode"), "rows")
            .unionByName(spark.table(replaced).agg(F.count(F.lit(1)).alias("rows"))
                         .select(F.lit("overwrite").alias("mode"), "rows"))
            .unionByName(spark.table(appended).agg(F.lit(clash).cast("long").alias("rows"))
                         .select(F.lit("clash_rejected").alias("mode"), "rows"))
            .unionByName(spark.table(appended).agg(F.lit(repeat).cast("long").alias("rows"))
                         .select(F.lit("repeat_rejected").alias("mode"), "rows")))


def _ingest_all(spark: SparkSession, sf: str) -> DataFrame:
    qa = adapter.load(spark, sf)
    src = scratch_path(spark, "site-xml")
    for name, df, attrs in (("Posts", qa.posts, POST_ATTRS), ("Users", qa.users, USER_ATTRS),
                            ("Votes", qa.votes, VOTE_ATTRS), ("Badges", qa.badges, BADGE_ATTRS),
                            ("Comments", qa.comments, COMMENT_ATTRS), ("Tags", qa.tags, TAG_ATTRS)):
        dump.write_dump(df, f"{src}/{name}.xml", attrs, compressed=True)
    site = "site_" + uuid.uuid4().hex[:10]
    chosen = ("posts", "users", "votes", "badges", "comments", "tags")
    args = PipelineArgs(site=site, source_dir=src, staging_dir=scratch_path(spark, "staging"),
                        tables=chosen, shards=8, max_rows_per_part=5000,
                        warehouse_dir=scratch_path(spark, "warehouse"), parallel_tables=3)
    run_pipeline(spark, args)
    return tables.table_counts(spark, {t: f"{site}.{t}" for t in chosen})


def _post_tags_dups(spark: SparkSession, sf: str) -> DataFrame:
    qa = adapter.load(spark, sf)
    doubled = qa.posts.withColumn(
        "tags", F.when(F.col("id") % 10 == 0, F.concat("tags", "tags")).otherwise(F.col("tags")))
    return derive.post_tags_duplicates(derive.post_tags(doubled, qa.tags))


def _refresh_post_tags(spark: SparkSession, sf: str) -> DataFrame:
    """D3: compute, check and store the relation; read back what was stored."""
    qa = adapter.load(spark, sf)
    name = "post_tags_" + uuid.uuid4().hex[:10]
    return derive.refresh_post_tags(spark, qa.posts, qa.tags, name,
                                    path=scratch_path(spark, name))


def _maintained_post_tags(spark: SparkSession, sf: str) -> DataFrame:
    """D3 by changes: an earlier state of posts and tags is stored, then brought up to date; read back what is stored."""
    qa = adapter.load(spark, sf)
    path = scratch_path(spark, "post-tags-kept")
    earlier = qa.posts.where("id % 56 <> 0").withColumn(
        "tags", F.when(F.col("id") % 88 == 0, F.lit("|status-o|gone|")).otherwise(F.col("tags")))
    tags = qa.tags.where("tag_name <> 'prio-3'").unionAll(qa.tags.limit(1).select(F.lit(99).alias("id"), F.lit("gone").alias("tag_name")))
    derive.maintain_post_tags(spark, earlier, tags, path, width=1 << 10)
    return derive.maintain_post_tags(spark, qa.posts, qa.tags, path, width=1 << 10).relation


def _list_files(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of the listed parts by folder: the listing joined with the parts' own file names."""
    out = scratch_path(spark, "posts-parts")
    staging.write_parts(adapter.load(spark, sf).posts, out, "id", shards=8, max_rows_per_part=1000)
    listed = files.list_files(spark, out, r"re:shard=[35]/part-").select(
        "path", F.regexp_extract("rel_path", "^(.*)/", 1).alias("folder"))
    rows = staging.read_parts(spark, out).select(F.regexp_replace("_metadata.file_path", "^file:/+", "file:/").alias("path"))
    return rows.join(listed, "path").groupBy("folder").agg(F.count(F.lit(1)).alias("rows"))


def _list_hidden(spark: SparkSession, sf: str) -> DataFrame:
    """Every file below a folder of documents by source, some folders hidden, with their rows: what a listing must not leave out."""
    root = scratch_path(spark, "documents-listed")
    docs = adapter.read_base(spark, sf, "documents").select("doc_id", F.concat(F.lit("s"), F.pmod("doc_id", F.lit(5))).alias("kind"))
    for kind, folder in enumerate(("s0", "_s1", ".s2", "s3/_deep", "s4/.deep/s")):
        docs.where(F.col("kind") == f"s{kind}").select(F.col("doc_id").cast("string")).coalesce(1).write.text(f"{root}/{folder}")
    text = files.list_files(spark, root, r"re:/part-[^/]*\.txt$")
    return text.select(F.regexp_extract("rel_path", "^(.*)/", 1).alias("folder"), "length")


def _ingest_wrapped(spark: SparkSession, sf: str) -> DataFrame:
    """Posts whose rows partly span lines through the pipeline: what its manifest found, and what it loaded."""
    src = scratch_path(spark, "wrapped-xml")
    dump.write_dump(adapter.load(spark, sf).posts, f"{src}/Posts.xml", POST_ATTRS, compressed=True, wrap_when=F.col("id") % 10 == 0)
    out = None
    for mode in (False, True):
        site, stage = "site_" + uuid.uuid4().hex[:10], scratch_path(spark, "staging")
        run_pipeline(spark, PipelineArgs(site=site, source_dir=src, staging_dir=stage, tables=("posts",), wrapped=mode,
                                         warehouse_dir=scratch_path(spark, "warehouse")))
        m = staging.read_manifest(spark, staged_manifest(spark, f"{stage}/{site}/posts"))
        one = spark.table(f"{site}.posts").agg(F.count(F.lit(1)).alias("loaded")).select(
            F.lit(mode).alias("wrapped"), F.lit(m.found_rows).cast("long").alias("found"), "loaded")
        out = one if out is None else out.unionByName(one)
    return out


def _restage_snapshots(spark: SparkSession, sf: str) -> DataFrame:
    """Votes staged twice, with writers that stop before and after the second commit: what readers find each time."""
    votes = adapter.load(spark, sf).votes
    root = scratch_path(spark, "votes-snapshots")

    class Stopped(Exception):
        pass

    def stop_at(step: str):
        def at(reached: str) -> None:
            if reached == step:
                raise Stopped(step)
        return at

    def stage(kind: int):
        return lambda folder: staging.write_parts(votes.where(F.col("vote_type_id") >= kind), folder, "id", shards=4)

    out = None
    for event, kind, at in (("first", 1, None), ("stopped before its commit", 2, "staged"), ("second", 2, None),
                            ("stopped after its commit", 3, "committed")):
        try:
            snapshots.write(spark, root, stage(kind), at=stop_at(at or ""))
        except Stopped:
            pass
        found = snapshots.newest(spark, root)
        one = staging.read_parts(spark, found.path).agg(F.count("*").alias("rows"), F.sum("id").alias("ids")).select(
            F.lit(event).alias("event"), F.lit(found.version).cast("int").alias("version"), "rows", "ids")
        out = one if out is None else out.unionByName(one)
    return out


def _appended_key_clashes(spark: SparkSession, sf: str) -> DataFrame:
    """Keys of a third batch of posts that one of the two batches before it holds, by the key index."""
    posts = adapter.load(spark, sf).posts.select((F.col("id").cast("long") * 1009).alias("key"), "id", "post_type_id")
    index = KeyIndex(spark, scratch_path(spark, "post-keys"))
    kept = posts.where(F.col("id") % 3 != 0)
    for kind in (1, 2):
        index.prepare(kept.where(F.col("post_type_id") == kind), "key").enter(f"type{kind}")
    index.compact()
    index.prepare(posts.where("id % 3 = 0 and id % 5 = 0"), "key").enter("third")
    batch = index.prepare(posts.where(F.col("id") % 2 == 0), "key")
    return batch.suspects(but="third")


def _part_problems(spark: SparkSession, sf: str) -> DataFrame:
    """Documents staged in sized parts, then parts taken away, added and cut short: what the check names, by shard."""
    out = scratch_path(spark, "documents-parts")
    docs = _documents(spark, sf)
    staging.write_parts(docs, out, "doc_id", shards=8, max_rows_per_part=100, part_bytes=1 << 16)
    staging.build_manifest(spark, out, table="documents", key="doc_id", columns=DOC_COLS, source="documents.parquet", shards=8,
                           as_table=True)
    paths.delete(spark, f"{out}/shard=3")
    docs.where(F.col("doc_id") % 8 == 5).write.mode("append").parquet(f"{out}/shard=5")
    for part in paths.children(spark, f"{out}/shard=6"):
        if part.name.startswith("part-"):
            paths.write_text(spark, f"{out}/shard=6/{part.name}", "cut")
    return staging.part_problems(spark, out).select("shard", "problem").distinct()


def _typed_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines written as votes, some values damaged: rejected values by column and reason, and the rows that load."""
    text = lambda c: F.col(c).cast("string")
    rows = adapter.read_base(spark, sf, "lineitem").select(
        F.when(F.col("l_orderkey") % 89 == 0, F.lit("")).otherwise((F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("string")).alias("id"),
        text("l_orderkey").alias("post_id"),
        F.when(F.col("l_partkey") % 101 == 0, F.concat(text("l_linenumber"), F.lit("x"))).otherwise(text("l_linenumber")).alias("vote_type_id"),
        F.when(F.col("l_suppkey") % 13 == 0, F.lit("1998-13-45T00:00:00")).otherwise(F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss"))
        .alias("creation_date"),
        text("l_suppkey").alias("user_id"),
        F.when(F.col("l_partkey") % 97 == 0, F.lit("99999999999")).alias("bounty_amount"))
    done = quarantine(rows, spec("votes"), scratch_path(spark, "votes-typed"), max_share=0.5)
    values = done.rejects.groupBy("column", "reason").agg(F.count("*").alias("n"), F.count_distinct("value").alias("distinct_values"))
    good = done.good.agg(F.lit("").alias("column"), F.lit("loaded").alias("reason"), F.count("*").alias("n"),
                         F.count_distinct("vote_type_id").alias("distinct_values"))
    return values.unionByName(good)


CHANGED_WIDTH = 16


def _source_changes(spark: SparkSession, sf: str) -> DataFrame:
    """Key ranges in which documents differ from a copy with a byte changed here and a row dropped there."""
    docs = adapter.read_base(spark, sf, "documents").select("doc_id", "text")
    other = F.when(F.col("text").startswith("x"), "y").otherwise("x")
    hit = (F.col("doc_id") % 211 == 5) & (F.length("text") > 0)
    now = docs.where("doc_id % 307 <> 11").withColumn(
        "text", F.when(hit, F.overlay("text", other, F.lit(1), F.lit(1))).otherwise(F.col("text")))
    trees = []
    for name, rows in (("was", docs), ("now", now)):
        trees.append(scratch_path(spark, f"documents-{name}"))
        fingerprint.write_tree(fingerprint.row_pieces(rows, F.col("doc_id"), [F.col("doc_id"), F.col("text")], CHANGED_WIDTH), trees[-1])
    return fingerprint.ranges(fingerprint.changed_pieces(spark, *trees), CHANGED_WIDTH)


def _padded_keys(spark: SparkSession, sf: str) -> DataFrame:
    """The key column with every second line's keys written with a leading zero."""
    return _lineitem_keys(spark, sf).withColumn(
        "id", F.when(F.col("line").cast("int") % 2 == 0, F.concat(F.lit("0"), F.col("id"))).otherwise(F.col("id")))


def _stream_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Posts land as two dump drops (questions, then answers); one
    availableNow stream picks up both, a second run finds nothing new."""
    posts = adapter.load(spark, sf).posts
    src = scratch_path(spark, "drop")
    dump.write_dump(posts.where(F.col("parent_id").isNull()), f"{src}/q", POST_ATTRS, compressed=True)
    dump.write_dump(posts.where(F.col("parent_id").isNotNull()), f"{src}/a", POST_ATTRS, compressed=True)
    out, ckpt = scratch_path(spark, "posts-stream"), scratch_path(spark, "posts-stream-ckpt")
    for _ in range(2):
        ingest_stream(spark, f"{src}/*", spec("posts"), out, ckpt).awaitTermination()
    return spark.read.parquet(out).select(*POST_COLS)  # batch_id folders are not a column here


PIECE = 1024


def _pieces_checked(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Documents as files (ASCII, one line each) in a torrent-like stream of
    1 KiB pieces; every 10th file has one byte changed in its first full
    piece, every 50th (doc_id % 50 = 7) is not written at all."""
    docs = _documents(spark, sf).select(
        "doc_id", F.regexp_replace("text", r"[^\x20-\x7e]", "?").alias("orig"))
    entries = (pieces.running_offsets(docs.withColumn("length", F.length("orig") + 1),
                                      "doc_id", "length", bucket=128)
               .withColumn("name", F.concat(F.lit("doc_id="), F.col("doc_id").cast("string"))))
    first = idiv(F.col("offset") + PIECE - 1, F.lit(PIECE))
    has_full = idiv(F.col("offset") + F.col("length"), F.lit(PIECE)) > first
    at = (first * PIECE - F.col("offset") + 1).cast("int")   # first byte of the first full piece
    ch = F.col("orig").substr(at, F.lit(1))
    corrupt = F.when((F.col("doc_id") % 10 == 0) & has_full,
                     F.overlay("orig", F.when(ch == "x", "y").otherwise("x"), at, F.lit(1)))
    root = scratch_path(spark, "pieces")
    files.write_line_files(entries.where(F.col("doc_id") % 50 != 7)
                           .select("doc_id", F.coalesce(corrupt, F.col("orig")).alias("body")), "doc_id", "body", root)
    present = (files.list_files(spark, root, r"re:/part-[^/]*\.txt$")
               .select(F.regexp_extract("rel_path", r"^(doc_id=\d+)/", 1).alias("name"), "path"))
    listed = entries.select("name", "offset", "length")
    # the file bytes are the line plus the newline the text writer adds
    content = F.concat(F.col("orig"), F.lit("\n"))
    digests = (pieces.file_pieces(listed, PIECE).join(entries.select("name", "orig"), "name")
               .select("piece_idx",
                       F.sha1(content.substr((F.col("pos") + 1).cast("int"), F.lit(PIECE)))
                       .alias("digest")))
    return pieces.verify_pieces(listed, present, digests, PIECE)


DUCK_PIECES = f"""d AS (
SELECT doc_id, regexp_replace(text, '[^\x20-\x7e]', '?', 'g') AS orig FROM documents),
e AS (
SELECT doc_id, orig, length(orig) + 1 AS len,
       CAST(coalesce(sum(length(orig) + 1) OVER (ORDER BY doc_id
                                                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
            AS BIGINT) AS off
FROM d),
f AS (
SELECT doc_id, orig, len, off, (off + {PIECE} - 1) // {PIECE} AS first_p, (off + len) // {PIECE} AS end_p,
       CAST((off + {PIECE} - 1) // {PIECE} * {PIECE} - off + 1 AS INTEGER) AS c
FROM e),
g AS (
SELECT doc_id, orig, first_p, end_p,
       CASE WHEN doc_id % 10 = 0 AND end_p > first_p
            THEN substr(orig, 1, c - 1) || CASE WHEN substr(orig, c, 1) = 'x' THEN 'y' ELSE 'x' END
                 || substr(orig, c + 1)
            ELSE orig END AS body
FROM f),
p AS (
SELECT g.doc_id, k AS piece_idx,
       sha1(substr(g.orig || chr(10), CAST(k * {PIECE} - e.off + 1 AS INTEGER), {PIECE})) AS want,
       sha1(substr(g.body || chr(10), CAST(k * {PIECE} - e.off + 1 AS INTEGER), {PIECE})) AS got
FROM g JOIN e USING (doc_id), range(g.first_p, g.end_p) t(k)
WHERE g.end_p > g.first_p)"""


def ingestion() -> dict[str, tuple]:
    reg: dict[str, tuple] = {}

    reg["scan_dump_rows"] = (
        lambda s, d: dump.read_dump(s, _posts_dump(s, d), spec("posts"))
        .select("id", "parent_id", "score", "owner_user_id", "body", "tags"),
        oracle(body="""
SELECT CAST(id AS VARCHAR) AS id, CAST(parent_id AS VARCHAR) AS parent_id,
       CAST(score AS VARCHAR) AS score, CAST(owner_user_id AS VARCHAR) AS owner_user_id,
       body, tags
FROM se_posts"""))

    reg["typed_projection"] = (
        lambda s, d: _typed_posts(s, _posts_dump(s, d)),
        oracle(body=DUCK_POSTS_TYPED))

    reg["snake_columns"] = (
        lambda s, d: dump.rename_to_snake(
            dump.read_dump(s, _posts_dump(s, d), spec("posts"), snake_names=False)
            .select("Id", "PostTypeId", "ParentId", "OwnerUserId", "LastEditorUserId")),
        oracle(body="""
SELECT CAST(id AS VARCHAR) AS id, CAST(post_type_id AS VARCHAR) AS post_type_id,
       CAST(parent_id AS VARCHAR) AS parent_id, CAST(owner_user_id AS VARCHAR) AS owner_user_id,
       CAST(last_editor_user_id AS VARCHAR) AS last_editor_user_id
FROM se_posts"""))

    reg["decode_entities"] = (
        lambda s, d: dump.read_dump(
            s, dump.write_dump(_documents(s, d).select(F.col("doc_id").cast("int").alias("id"), "text"),
                               scratch_path(s, "Comments.xml"), {"id": "Id", "text": "Text"}),
            spec("comments")).select(F.col("id").cast("int").alias("id"), "text"),
        oracle(body="SELECT CAST(doc_id AS INTEGER) AS id, nullif(text, '') AS text FROM documents"))

    reg["empty_to_null"] = (
        lambda s, d: dump.typed(dump.read_dump(
            s, dump.write_dump(adapter.load(s, d).users, scratch_path(s, "Users.xml"), USER_ATTRS,
                               empty_for_null=("WebsiteUrl",)),
            spec("users")), spec("users")).select("id", "reputation", "website_url"),
        oracle(body="SELECT id, reputation, website_url FROM se_users"))

    reg["audit_skipped_rows"] = (
        lambda s, d: dump.audit_rows(s, _posts_dump(s, d, wrap_when=F.col("id") % 10 == 0))
        .agg(F.sum("row_tags").alias("row_tags"), F.sum("parsed").alias("parsed"),
             F.sum("skipped").alias("skipped")),
        oracle(body="""
SELECT count(*) AS row_tags, count(*) FILTER (WHERE id % 10 <> 0) AS parsed,
       count(*) FILTER (WHERE id % 10 = 0) AS skipped
FROM se_posts"""))

    reg["scan_wrapped_rows"] = (
        lambda s, d: _typed_posts(s, _posts_dump(s, d, wrap_when=F.col("id") % 10 == 0), wrapped=True),
        oracle(body=DUCK_POSTS_TYPED))

    reg["check_missing_keys"] = (
        lambda s, d: staging.missing_keys(_lineitem_keys(s, d), "id"),
        oracle(DUCK_LI_KEYS, body="""
SELECT id, order_key, line, part_key FROM li
WHERE id IS NULL OR id = '' OR TRY_CAST(trim(id) AS BIGINT) IS NULL"""))

    reg["check_duplicate_keys"] = (
        lambda s, d: staging.duplicate_keys(_lineitem_keys(s, d), "id"),
        oracle(DUCK_LI_KEYS, body="""
SELECT id, count(*) AS n FROM li WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1"""))

    reg["shard_by_modulo"] = (
        lambda s, d: staging.shard_by_key(adapter.load(s, d).posts, "id", 8).select("id", "shard"),
        oracle(body="SELECT id, CAST(id % 8 AS INTEGER) AS shard FROM se_posts"))

    reg["manifest_counts"] = (
        _manifest_counts,
        oracle(body="SELECT CAST(id % 8 AS INTEGER) AS shard, count(*) AS rows FROM se_posts GROUP BY 1"))

    reg["csv_parts_roundtrip"] = (
        _parts_roundtrip,
        "SELECT doc_id, text, lang, source, n_chars FROM documents")

    reg["manifest_load"] = (
        _manifest_load,
        "SELECT doc_id, text, lang, source, n_chars FROM documents")

    reg["append_vs_truncate"] = (
        _append_vs_truncate,
        oracle(body="""
SELECT 'append' AS mode, count(*) AS rows FROM se_votes
UNION ALL SELECT 'overwrite', count(*) FROM se_votes
UNION ALL SELECT 'clash_rejected', CAST(1 AS BIGINT)
UNION ALL SELECT 'repeat_rejected', CAST(1 AS BIGINT)"""))

    reg["ingest_all_tables"] = (
        _ingest_all,
        oracle(body="""
SELECT 'posts' AS "table", count(*) AS rows FROM se_posts
UNION ALL SELECT 'users', count(*) FROM se_users
UNION ALL SELECT 'votes', count(*) FROM se_votes
UNION ALL SELECT 'badges', count(*) FROM se_badges
UNION ALL SELECT 'comments', count(*) FROM se_comments
UNION ALL SELECT 'tags', count(*) FROM se_tags"""))

    reg["post_tags_duplicates"] = (
        _post_tags_dups,
        oracle("""pt AS (
SELECT x.post_id, t.id AS tag_id
FROM (SELECT id AS post_id,
             unnest(string_split(trim(CASE WHEN id % 10 = 0 THEN tags || tags ELSE tags END, '|'), '|'))
             AS tag_name
      FROM se_posts WHERE tags <> '') x
JOIN se_tags t ON t.tag_name = x.tag_name)""", body="""
SELECT post_id, tag_id, count(*) AS n FROM pt GROUP BY post_id, tag_id HAVING count(*) > 1"""))

    reg["stream_ingest_rows"] = (_stream_ingest, oracle(body=DUCK_POSTS_TYPED))

    reg["post_tags_refresh"] = (
        _refresh_post_tags,
        oracle(adapter.DUCK_POST_TAGS, body="SELECT post_id, tag_id, tag_name FROM se_post_tags"))

    reg["post_tags_maintained"] = (
        _maintained_post_tags,
        oracle(adapter.DUCK_POST_TAGS, body="SELECT post_id, tag_id, tag_name FROM se_post_tags"))

    reg["list_files_filtered"] = (
        _list_files,
        oracle(body="""
SELECT 'shard=' || CAST(id % 8 AS VARCHAR) AS folder, count(*) AS rows FROM se_posts
WHERE id % 8 IN (3, 5) GROUP BY 1"""))

    reg["list_files_hidden"] = (
        _list_hidden,
        """
SELECT folder, sum(length(CAST(doc_id AS VARCHAR)) + 1)::BIGINT AS length
FROM (VALUES (0, 's0'), (1, '_s1'), (2, '.s2'), (3, 's3/_deep'), (4, 's4/.deep/s')) AS f(kind, folder)
JOIN documents ON doc_id % 5 = kind GROUP BY folder""")

    reg["piece_hash_bad"] = (
        lambda s, d: _pieces_checked(s, d)[1],
        "WITH " + DUCK_PIECES + """
SELECT 'doc_id=' || CAST(doc_id AS VARCHAR) AS name, piece_idx FROM p WHERE want <> got AND doc_id % 50 <> 7""")

    reg["ingest_wrapped_rows"] = (
        _ingest_wrapped,
        oracle(body="""
SELECT false AS wrapped, count(*) AS found, count(*) FILTER (WHERE id % 10 <> 0) AS loaded FROM se_posts
UNION ALL SELECT true, count(*), count(*) FROM se_posts"""))

    reg["restage_snapshots"] = (
        _restage_snapshots,
        oracle(body="""
SELECT event, CAST(version AS INTEGER) AS version, count(*) AS rows, CAST(sum(id) AS BIGINT) AS ids
FROM (VALUES ('first', 1, 1), ('stopped before its commit', 1, 1), ('second', 2, 2), ('stopped after its commit', 3, 3))
     AS e(event, version, kind)
JOIN se_votes ON vote_type_id >= kind GROUP BY event, version"""))

    reg["appended_key_clashes"] = (
        _appended_key_clashes,
        oracle(body="SELECT CAST(id AS BIGINT) * 1009 AS key FROM se_posts WHERE id % 2 = 0 AND id % 3 <> 0"))

    reg["manifest_part_problems"] = (
        _part_problems,
        """
SELECT DISTINCT CAST(doc_id % 8 AS INTEGER) AS shard,
       CASE doc_id % 8 WHEN 3 THEN 'missing' WHEN 5 THEN 'extra' ELSE 'size' END AS problem
FROM documents WHERE doc_id % 8 IN (3, 5, 6)""")

    reg["typed_quarantine"] = (
        _typed_quarantine,
        """
WITH v AS (
SELECT l_orderkey % 89 = 0 AS no_key, l_partkey % 101 = 0 AS bad_type, l_suppkey % 13 = 0 AS bad_date,
       l_partkey % 97 = 0 AS too_big, l_linenumber AS kind FROM lineitem)
SELECT 'id' AS "column", 'missing primary key value' AS reason, count(*) AS n, CAST(1 AS BIGINT) AS distinct_values
FROM v WHERE no_key HAVING count(*) > 0
UNION ALL SELECT 'vote_type_id', 'invalid input for int', count(*), count(DISTINCT kind) FROM v WHERE bad_type HAVING count(*) > 0
UNION ALL SELECT 'creation_date', 'invalid input for timestamp_ntz', count(*), 1 FROM v WHERE bad_date HAVING count(*) > 0
UNION ALL SELECT 'bounty_amount', 'invalid input for int', count(*), 1 FROM v WHERE too_big HAVING count(*) > 0
UNION ALL SELECT '', 'loaded', count(*), count(DISTINCT kind) FROM v WHERE NOT (no_key OR bad_type OR bad_date OR too_big)""")

    reg["source_changes"] = (
        _source_changes,
        f"""
WITH d AS (
SELECT doc_id // {CHANGED_WIDTH} AS piece, doc_id % 307 = 11 AS dropped, doc_id % 211 = 5 AND length(text) > 0 AS edited
FROM documents)
SELECT piece * {CHANGED_WIDTH} AS low, piece * {CHANGED_WIDTH} + {CHANGED_WIDTH - 1} AS high,
       CASE WHEN bool_and(dropped) THEN 'removed' ELSE 'changed' END AS change
FROM d GROUP BY piece HAVING bool_or(dropped OR edited)""")

    reg["check_duplicate_keys_typed"] = (
        lambda s, d: staging.duplicate_keys(_padded_keys(s, d), "id"),
        oracle(DUCK_LI_KEYS, body="""
SELECT coalesce(CAST(TRY_CAST(trim(k) AS BIGINT) AS VARCHAR), k) AS id, count(*) AS n
FROM (SELECT CASE WHEN CAST(line AS INTEGER) % 2 = 0 THEN '0' || id ELSE id END AS k FROM li)
WHERE k IS NOT NULL GROUP BY 1 HAVING count(*) > 1"""))

    reg["piece_hash_audit"] = (
        lambda s, d: _pieces_checked(s, d)[0],
        "WITH " + DUCK_PIECES + """
SELECT 'doc_id=' || CAST(e.doc_id AS VARCHAR) AS name,
       CASE WHEN e.doc_id % 50 = 7 THEN 'missing'
            WHEN count(p.piece_idx) FILTER (WHERE p.want <> p.got) > 0 THEN 'mismatch' ELSE 'ok' END AS status,
       CASE WHEN e.doc_id % 50 = 7 THEN 0
            ELSE count(p.piece_idx) FILTER (WHERE p.want <> p.got) END AS n_bad,
       CASE WHEN e.doc_id % 50 = 7 THEN NULL
            ELSE min(p.piece_idx) FILTER (WHERE p.want <> p.got) END AS first_bad
FROM e LEFT JOIN p ON p.doc_id = e.doc_id
GROUP BY e.doc_id""")

    return reg
