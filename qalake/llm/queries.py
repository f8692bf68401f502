"""The registered queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*cols)


def piece_model_path() -> str:
    import public_tokenizers
    return str(public_tokenizers.path("piece_bpe_32k.model"))


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text, and whether decoding them gives the text back."""
    from qalake.llm.sentencepiece_codec import encode
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    out = encode(docs, piece_model_path(), decoded="decoded")
    plain = F.translate(F.coalesce("text", F.lit("")), "▁", " ")
    return out.select("doc_id", "token_ids", F.size("token_ids").cast("long").alias("n_tokens"),
                      F.sha2("decoded", 256).alias("decoded_sha256"),
                      (F.col("decoded") == plain).alias("round_trip"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every whole text."""
    from qalake.llm.quality import quality
    return quality(_table(spark, sf_dir, "documents", "doc_id", "text"),
                   _table(spark, sf_dir, "labels", "doc_id", "quality"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Position, length and checksum of every document's ids, read back from the written files."""
    import public_tokenizers

    from qalake.llm.token_files import token_files
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    return token_files(docs, str(public_tokenizers.path("word_bpe_49k.json")), end_id=1)


def op2_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best other vectors of every vector whose id is divisible by 50."""
    from qalake.llm.search import top_k
    return top_k(_table(spark, sf_dir, "embeddings", "vec_id", "embedding"), F.col("vec_id") % 50 == 0, k=5)


#: Score of two vectors' whole numbers; DuckDB multiplies them as doubles, exactly at these sizes.
OP2_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 50 = 0
), r AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n, vec_id, score
  FROM s
)
SELECT query_id, n::INTEGER AS rank, vec_id, score FROM r WHERE n <= 5
"""


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every whole text."""
    from qalake.llm.pii import find
    return find(_table(spark, sf_dir, "documents", "doc_id", "text"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that a 100-byte string which also starts earlier covers."""
    from qalake.llm.suffix_dedup import deduplicate
    return deduplicate(_table(spark, sf_dir, "documents", "doc_id", "text"))


def op5_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links, components and kept rows of all embeddings at cosine 0.95."""
    from qalake.llm.vector_dedup import near_duplicates
    return near_duplicates(_table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


OP5_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION
  SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a
), part AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
n AS (SELECT a, count(*) AS n_links FROM link GROUP BY a)
SELECT e.vec_id, coalesce(n.n_links, 0)::BIGINT AS n_links, part.component_id, e.vec_id = part.component_id AS kept
FROM embeddings e JOIN part ON e.vec_id = part.a LEFT JOIN n ON e.vec_id = n.a
"""


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents by two-word shingles."""
    from qalake.llm.minhash import near_duplicates
    return near_duplicates(_table(spark, sf_dir, "documents", "doc_id", "text"), words=2)


#: Pairs of documents that share a shingle are counted by the join on it; words hold no blanks.
OP6_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                              'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) = 1 THEN words
                      ELSE list_distinct(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]))
                 END AS shingles
  FROM w
), e AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM s),
link AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a
), part AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT s.doc_id, len(s.shingles)::BIGINT AS n_shingles, part.component_id, s.doc_id = part.component_id AS kept
FROM s JOIN part ON s.doc_id = part.a
"""


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix of all documents takes of each."""
    from qalake.llm.mixing import mix
    docs = _table(spark, sf_dir, "documents", "doc_id", "text", "source")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken", "n_copies", "finish_time")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every whole text."""
    from qalake.llm.toxicity import toxicity
    return toxicity(_table(spark, sf_dir, "documents", "doc_id", "text"),
                    _table(spark, sf_dir, "labels", "doc_id", "toxic"))


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every whole text and in what is encoded inside it."""
    from qalake.llm.secret_scan import KINDS, scan
    found = scan(_table(spark, sf_dir, "documents", "doc_id", "text"))
    base = F.filter("spans", lambda s: s["layer"] == "")
    joined = lambda spans: F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", *(count(k).alias(f"n_{k}") for k in KINDS),
                        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    from qalake.llm.lexical import search
    return search(_table(spark, sf_dir, "benchmark", "item_id", "text"),
                  _table(spark, sf_dir, "documents", "doc_id", "text"), k=10)


OP12_SQL = r"""
WITH t AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents WHERE text IS NOT NULL
), d AS (SELECT doc_id, count(*) AS n FROM t GROUP BY doc_id),
c AS (SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM d),
q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark WHERE text IS NOT NULL
), p AS (SELECT term, doc_id, count(*) AS tf FROM t WHERE term IN (SELECT term FROM q) GROUP BY term, doc_id),
w AS (SELECT term, floor(1000 * ln((2 * any_value(c.docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
      FROM p, c GROUP BY term),
i AS (
  SELECT p.term, p.doc_id, w.w * ((1000000000 * p.tf) // (1000 * p.tf + 8 * (10 + (90 * d.n * c.docs) // c.total))) AS impact
  FROM p JOIN w ON p.term = w.term JOIN d ON p.doc_id = d.doc_id, c
), s AS (SELECT q.item_id, i.doc_id, sum(i.impact)::BIGINT AS score FROM q JOIN i ON q.term = i.term GROUP BY q.item_id, i.doc_id),
r AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS n, doc_id, score
  FROM s WHERE score > 0
)
SELECT item_id, n::INTEGER AS rank, doc_id, score FROM r WHERE n <= 10
"""


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near words, forms and roots of the words of all documents."""
    from qalake.llm.spelling import variants
    return variants(_table(spark, sf_dir, "documents", "doc_id", "text"), damage=97)


QUERIES = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_top_k": op2_top_k,
    "op3_pii": op3_pii,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_vector_dedup": op5_vector_dedup,
    "op6_minhash": op6_minhash,
    "op7_mixing": op7_mixing,
    "op8_quality": op8_quality,
    "op9_token_files": op9_token_files,
    "op10_toxicity": op10_toxicity,
    "op11_secret_scan": op11_secret_scan,
    "op12_lexical_search": op12_lexical_search,
    "op13_spelling": op13_spelling,
}
ORACLES: dict[str, str] = {
    "op2_top_k": OP2_SQL,
    "op5_vector_dedup": OP5_SQL,
    "op6_minhash": OP6_SQL,
    "op12_lexical_search": OP12_SQL,
}
