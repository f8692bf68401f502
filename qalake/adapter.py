"""Dump-shaped tables derived from the driver's star-schema tables.

The analytics need Q&A tables (posts, users, votes, badges, comments, tags).
The test data has none, so these are derived from ``customer``, ``orders``,
``lineitem``, ``events`` and ``documents`` by one SQL text that runs both in
Spark (``spark.sql`` with DataFrame arguments, no global view names) and in
DuckDB (as a CTE prefix of every oracle query). Same text, same values.

All work here grows with the input tables; nothing is sampled or capped.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# (name, SQL body). ``{x}`` names another input (a parquet table or an earlier
# view); ``{TS}`` is the zone-less timestamp type of the engine.
VIEWS: list[tuple[str, str]] = [
    ("se_users", """
SELECT CAST(c_custkey AS INT) AS id,
       CAST(floor(abs(c_acctbal)) AS INT) + 1 AS reputation,
       CAST(CAST('1994-01-01' AS DATE) + CAST(c_custkey % 365 AS INT) AS {TS}) AS creation_date,
       c_name AS display_name,
       CASE WHEN c_custkey % 5 = 0 THEN NULL
            ELSE 'https://www.site' || CAST(c_custkey % 50 AS VARCHAR(10)) || '.example/' END AS website_url,
       CAST(c_custkey % 97 AS INT) AS up_votes,
       CAST(c_custkey % 13 AS INT) AS down_votes
FROM {customer}"""),
    ("se_answers", """
SELECT CAST(l_orderkey * 8 + l_linenumber AS INT) AS id,
       CAST(l_orderkey * 8 AS INT) AS parent_id,
       min(l_shipdate) AS creation_date,
       CAST(floor(min(l_quantity)) AS INT) % 12 - 2 AS score,
       CAST(CASE WHEN (l_orderkey * 8 + l_linenumber) % 41 = 0 THEN NULL ELSE min(l_suppkey) END AS INT) AS owner_user_id,
       CASE WHEN min(l_returnflag) = 'R' THEN 'THANKS a lot!'
            WHEN min(l_returnflag) = 'N' THEN 'See http://www.site' || CAST(min(l_partkey) % 50 AS VARCHAR(10)) || '.example/a'
            ELSE 'Use the index' END AS body
FROM {lineitem}
WHERE l_linenumber BETWEEN 1 AND 7
GROUP BY l_orderkey, l_linenumber"""),
    ("se_posts", """
SELECT CAST(o.o_orderkey * 8 AS INT) AS id, 1 AS post_type_id,
       CASE WHEN o.o_orderstatus = 'F' THEN a.first_answer END AS accepted_answer_id,
       CAST(NULL AS INT) AS parent_id, o.o_orderdate AS creation_date,
       CAST(o.o_orderkey % 11 AS INT) - 2 AS score,
       CAST(floor(o.o_totalprice / 1000) AS INT) AS view_count,
       'How to ' || o.o_orderpriority AS body,
       CAST(CASE WHEN o.o_orderkey % 37 = 0 THEN NULL WHEN o.o_orderkey % 4 = 0 THEN o.o_custkey % 100 ELSE o.o_custkey END AS INT) AS owner_user_id,
       CAST(CASE WHEN o.o_orderkey % 6 = 0 THEN o.o_custkey % 50 WHEN o.o_orderkey % 3 = 0 THEN o.o_custkey END AS INT) AS last_editor_user_id,
       o.o_orderdate AS last_activity_date,
       CASE WHEN o.o_orderkey % 2 = 0 THEN o.o_orderpriority
            ELSE o.o_orderpriority || ' and a longer title' END AS title,
       CASE WHEN o.o_orderkey % 29 = 0 THEN NULL
            ELSE '|status-' || lower(o.o_orderstatus) || '|prio-' || substr(o.o_orderpriority, 1, 1) || '|' END AS tags,
       CAST(coalesce(a.n, 0) AS INT) AS answer_count,
       CASE WHEN o.o_orderkey % 17 = 0 THEN o.o_orderdate END AS closed_date,
       CASE WHEN o.o_orderkey % 23 = 0 THEN o.o_orderdate END AS community_owned_date
FROM {orders} o
LEFT JOIN (SELECT parent_id, count(*) AS n, min(id) AS first_answer
           FROM {se_answers} GROUP BY parent_id) a
       ON a.parent_id = o.o_orderkey * 8
UNION ALL
SELECT id, 2, NULL, parent_id, creation_date, score, NULL, body, owner_user_id,
       CASE WHEN id % 10 = 0 THEN CAST(id % 50 AS INT) WHEN id % 5 = 0 THEN owner_user_id + 1 END,
       creation_date, NULL, NULL, NULL, NULL,
       CASE WHEN id % 31 = 0 THEN creation_date END
FROM {se_answers}"""),
    ("se_votes", """
SELECT CAST(event_id AS INT) AS id,
       -- spread over all questions and their answers; one vote in ten goes to few hot ones
       CAST((CASE WHEN event_id % 10 = 0 THEN event_id % 50
                  ELSE (event_id * 7919) % (SELECT count(*) FROM {orders}) END) * 8 + (event_id % 3) AS INT) AS post_id,
       CASE event_type WHEN 'click' THEN 2 WHEN 'view' THEN 2 WHEN 'error' THEN 3
                       WHEN 'purchase' THEN 9 ELSE 1 END AS vote_type_id,
       ts AS creation_date,
       CAST(CASE WHEN event_type = 'purchase' THEN user_id END AS INT) AS user_id,
       CAST(CASE WHEN event_type = 'purchase' THEN 50 * (1 + event_id % 10) END AS INT) AS bounty_amount
FROM {events}"""),
    ("se_badges", """
SELECT CAST(event_id AS INT) AS id, CAST(user_id AS INT) AS user_id,
       CASE event_type WHEN 'signup' THEN 'Guru' ELSE 'Popular Question' END AS name,
       ts AS date
FROM {events}
WHERE event_type IN ('signup', 'view')"""),
    ("se_comments", """
SELECT CAST(doc_id AS INT) AS id,
       CAST((CASE WHEN doc_id % 5 = 0 THEN doc_id % 100
                  ELSE (doc_id * 31) % (SELECT count(*) FROM {orders}) END) * 8 AS INT) AS post_id,
       CAST(n_chars % 7 AS INT) AS score,
       CASE WHEN doc_id % 4 = 0 THEN 'try www.site' || CAST(doc_id % 50 AS VARCHAR(10)) || '.example now'
            ELSE text END AS text,
       CAST(CAST('2001-07-01' AS DATE) + CAST(doc_id % 120 AS INT) AS {TS}) AS creation_date,
       CAST(CASE WHEN doc_id % 3 = 0 THEN doc_id % 100
                 ELSE doc_id % (SELECT count(*) FROM {customer}) END AS INT) AS user_id
FROM {documents}"""),
    # the tag dimension of the adapter: a fixed list of seven tags
    ("se_tags", """
SELECT * FROM (VALUES (1, 'status-f'), (2, 'status-o'), (3, 'status-p'),
                      (4, 'prio-1'), (5, 'prio-2'), (6, 'prio-3'), (7, 'prio-4')) AS t(id, tag_name)"""),
]

BASE_TABLES = ("customer", "lineitem", "orders", "events", "documents")
_VIEW_NAMES = [n for n, _ in VIEWS]


def _duck_text(body: str) -> str:
    subst = {t: t for t in BASE_TABLES}
    subst.update({v: v for v in _VIEW_NAMES})
    subst["TS"] = "TIMESTAMP"
    return body.format(**subst)


def duckdb_ctes() -> str:
    """The adapter as a list of CTEs (without the leading WITH)."""
    return ",\n".join(f"{name} AS ({_duck_text(body)}\n)" for name, body in VIEWS)


# post_tags (D1) in DuckDB words, used by the oracles that read it
DUCK_POST_TAGS = """se_post_tags AS (
SELECT x.post_id, t.id AS tag_id, t.tag_name
FROM (SELECT id AS post_id, unnest(string_split(trim(tags, '|'), '|')) AS tag_name
      FROM se_posts WHERE tags <> '') x
JOIN se_tags t ON t.tag_name = x.tag_name
)"""


def oracle(*ctes: str, body: str) -> str:
    """Adapter CTEs + extra CTEs + final query, one DuckDB statement."""
    parts = [duckdb_ctes(), *ctes]
    return "WITH " + ",\n".join(parts) + "\n" + body


@dataclass
class QATables:
    """The dump-shaped DataFrames, all lazily derived from the inputs."""
    users: DataFrame
    posts: DataFrame
    votes: DataFrame
    badges: DataFrame
    comments: DataFrame
    tags: DataFrame
    answers: DataFrame


def read_base(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Rows, about, that one task groups or sorts when answers and posts are derived.
TASK_ROWS = 1 << 19


def _dealt(rows: DataFrame, key: Column) -> DataFrame:
    """The rows dealt by ``key`` over tasks of about ``TASK_ROWS``; a small table as it is.

    Keys are nearly unique, so grouping before the shuffle would hold a whole file split's rows
    and save nothing; and a fixed number of tasks after it would hold more with every input.
    The count is read from the parquet footers.
    """
    n = rows.count()
    if n <= 2 * TASK_ROWS:
        return rows
    return rows.repartition(max(-(-n // TASK_ROWS), int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))), key)


def load(spark: SparkSession, sf_dir: str) -> QATables:
    """Derive the six dump-shaped tables from the parquet inputs at ``sf_dir``."""
    frames: dict[str, DataFrame] = {t: read_base(spark, sf_dir, t) for t in BASE_TABLES}
    dealt = {"se_answers": {"lineitem": _dealt(frames["lineitem"], F.col("l_orderkey"))},
             "se_posts": {"orders": _dealt(frames["orders"], F.col("o_orderkey") * 8)}}
    for name, body in VIEWS:
        used = {k: v for k, v in (frames | dealt.get(name, {})).items() if "{" + k + "}" in body}
        frames[name] = spark.sql(body.replace("{TS}", "TIMESTAMP_NTZ"), **used)
    return QATables(users=frames["se_users"], posts=frames["se_posts"],
                    votes=frames["se_votes"], badges=frames["se_badges"],
                    comments=frames["se_comments"], tags=frames["se_tags"],
                    answers=frames["se_answers"])


TABLE_NAMES = ("users", "posts", "votes", "badges", "comments", "tags")


def stage(qa: QATables, out_dir: str, *, buckets: int | None = None,
          db: str | None = None) -> dict[str, str]:
    """Write the six tables once (load once, query many).

    With ``buckets``, posts are bucketed and sorted by ``id`` and votes by
    ``post_id`` (catalog tables in ``db``), so the per-post vote aggregate and
    the posts/votes join read co-located buckets without a shuffle.
    Returns table -> path (or qualified table name when bucketed).
    """
    out: dict[str, str] = {}
    bucket_keys = {"posts": "id", "votes": "post_id"}
    for name in TABLE_NAMES:
        df = getattr(qa, name)
        path = f"{out_dir.rstrip('/')}/{name}"
        if buckets and name in bucket_keys and db:
            key = bucket_keys[name]
            (df.write.mode("overwrite").format("parquet").option("path", path)
             .bucketBy(buckets, key).sortBy(key).saveAsTable(f"{db}.{name}"))
            out[name] = f"{db}.{name}"
        else:
            df.write.mode("overwrite").parquet(path)
            out[name] = path
    return out


def load_stored(spark: SparkSession, locations: dict[str, str]) -> QATables:
    """QATables over staged tables (paths or catalog names)."""
    def read(loc: str) -> DataFrame:
        return spark.table(loc) if "/" not in loc else spark.read.parquet(loc)
    frames = {n: read(loc) for n, loc in locations.items()}
    return QATables(answers=frames["posts"].where("parent_id IS NOT NULL"), **frames)
