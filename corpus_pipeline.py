"""A training corpus from ``documents``: filter, deduplicate, redact, mix, tokenise.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it
kept; all but the last return the columns of ``documents``.

Edge cases (each operator's docstring has its own). Null texts count as empty; quality scores them
like any text. Null ids are never duplicates of anything and are all kept; rows of one id are
one node for near-duplicates: the least id of a group stays with all its rows. Repeated rows
stay repeated and take their places in the mix one by one. An empty table gives empty
stages. Texts of any length are read whole; further columns pass through.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qalake.llm.common import TEXT_ROWS, materialize
from qalake.llm.minhash import keep_one
from qalake.llm.mixing import mixed_documents
from qalake.llm.pii import redact
from qalake.llm.quality import keep_good
from qalake.llm.queries import piece_model_path
from qalake.llm.sentencepiece_codec import encode


def _text_batches(spark: SparkSession) -> None:
    """Rows that cross to Python at once, for a session whose rows hold whole texts: Spark's default suits numbers.

    A stage's result is written by its caller, so the setting has to outlast the stage.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(TEXT_ROWS))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    _text_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    return keep_good(docs, labels)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group at similarity 0.8 of five-word shingles: the least id."""
    _text_batches(spark)
    return keep_one(docs, words=5, percent=80)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind; n_chars follows the new text."""
    _text_batches(spark)
    out = redact(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) \
        if "n_chars" in docs.columns else out


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of all sources in the proportions of their weights; a row for each copy."""
    return mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document, their number, and whether they decode to its text."""
    _text_batches(spark)
    plain = F.translate(F.coalesce("text", F.lit("")), "▁", " ")
    return (encode(docs, piece_model_path(), decoded="decoded")
            .withColumn("n_tokens", F.size("token_ids").cast("long"))
            .withColumn("round_trip", F.col("decoded") == plain).drop("decoded"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mixing", mixing),
    ("tokens", tokens),
]

#: The stages' models and signatures have no SQL form; tests compare the pipeline with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each stage's result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs, f"pipeline-{name}")
    return docs
