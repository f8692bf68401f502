"""The pipeline's stages against brute force on the stage's own input."""

import re

import pytest

import corpus_pipeline
from qalake.llm.pii import base_spans
from qalake.llm.quality import quality

from .test_minhash import brute

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """(input, output) rows of every stage."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, docs, SF)
        rows = got.collect()
        out[name] = (docs.collect(), rows, got.columns)
        docs = spark.createDataFrame(rows, got.schema)
    return out


def test_columns(stages):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    for n in names[:-1]:
        assert stages[n][2] == ["doc_id", "text", "lang", "source", "n_chars"]


def test_quality_keeps_clean_documents(spark, stages):
    docs, kept, _ = stages["quality"]
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    ids = {r["doc_id"] for r in kept}
    good = [r["doc_id"] for r in docs if labels.get(r["doc_id"]) == 1]
    assert sum(i in ids for i in good) >= 0.95 * len(good)
    want = quality(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    assert ids == {r["doc_id"] for r in want.where("predicted = 1").collect()}


def test_near_duplicates_keep_one(stages):
    docs, kept, _ = stages["near_duplicates"]
    part = brute([(r["doc_id"], r["text"]) for r in docs], 5)
    assert sorted(r["doc_id"] for r in kept) == sorted(i for i, c in part.items() if i == c)


def test_personal_data_goes(stages):
    docs, out, _ = stages["personal_data"]
    assert sorted(r["doc_id"] for r in docs) == sorted(r["doc_id"] for r in out)
    for r in out:
        assert base_spans(r["text"]) == [] and r["n_chars"] == len(r["text"])


def test_mixing_repeats_documents(stages):
    docs, out, _ = stages["mixing"]
    count = lambda t: len(re.findall("[^\x20\x09-\x0d]+", t or ""))
    total, taken = sum(count(r["text"]) for r in docs), sum(count(r["text"]) for r in out)
    assert 0.9 * total <= taken <= total


def test_tokens(stages):
    sp = pytest.importorskip("sentencepiece").SentencePieceProcessor(
        model_file=__import__("qalake.llm.queries", fromlist=["x"]).piece_model_path())
    docs, out, _ = stages["tokens"]
    assert len(docs) == len(out)
    assert all(r["token_ids"] == sp.encode(r["text"]) and r["round_trip"] and r["n_tokens"] == len(r["token_ids"]) for r in out)


def test_run_registers_and_guard(spark):
    import __spark_entry__ as entry
    names = set(entry.queries())
    assert {"pipeline", *(f"op{n}_" + s for n, s in ((1, "sentencepiece"), (2, "top_k"), (9, "token_files")))} <= names
    assert corpus_pipeline.run(spark, SF).count() > 0
