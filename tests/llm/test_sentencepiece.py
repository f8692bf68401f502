"""Ids equal the library's; decoding gives the text back; odd rows."""

import random

import pyarrow as pa
import pytest

from qalake.llm.queries import piece_model_path
from qalake.llm.sentencepiece_codec import Encoder, decode, decode_ids, encode, load_model

from .data import documents, odd_documents

sentencepiece = pytest.importorskip("sentencepiece")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=piece_model_path())


def check(library, texts):
    enc = Encoder(piece_model_path())
    flat, n = enc.encode(pa.array(texts, pa.string()))
    at = 0
    got = []
    for k in n.tolist():
        got.append(flat[at:at + k].tolist())
        at += k
    want = library.encode([t or "" for t in texts], num_threads=1)
    assert got == want
    assert decode_ids(load_model(piece_model_path()), flat, n) == library.decode(want)


def test_ids_and_texts_equal_the_library(library):
    rng = random.Random(1)
    texts = [None, "", " ", "  ", "a  b", "   a", "a" * 50, "ab" * 300, " " * 40, " " * 17 + "the", "x\n\n\n  y\t",
             "日本語 テキスト", "😀 z", "▁▁x", "\x00a", "1234567 89.00", "x" + " " * 100 + "y", "é" * 300]
    for alphabet in ("ab e\n .", "etaoinshrdlu ,.ETSing", " aé中😀αа\n-..."):
        texts += ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 50))) for _ in range(400)]
    check(library, texts)
    check(library, ["".join(rng.choice("etaoin ") for _ in range(60_000)), "".join(rng.choice("etaoin") for _ in range(3000))])


def test_documents_of_the_table(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    for r in encode(docs, piece_model_path(), decoded="back").collect():
        assert r["token_ids"] == library.encode(r["text"] or "")
        assert r["back"] == (r["text"] or "").replace("▁", " ")


def test_columns_pass_and_clashes_are_replaced(spark):
    docs = documents(spark).withColumnRenamed("size", "token_ids").withColumnRenamed("score", "decoded")
    out = decode(encode(docs, piece_model_path()).drop("decoded"), piece_model_path())
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "_id", "token_ids", "decoded"]
    rows = out.collect()
    assert len(rows) == len(odd_documents())
    assert all(r["decoded"] == (r["text"] or "") for r in rows)


def test_empty_table(spark):
    assert encode(documents(spark, []), piece_model_path()).count() == 0


def test_long_words_equal_the_library(library):
    rng = random.Random(4)
    hexa = "".join(rng.choice("0123456789abcdef") for _ in range(20_000))
    code = "".join(rng.choice(["function(", "return", "var_", "{}", "=>", "the", "é", "日", "\x00", "ing", "x1", "=", "ab"]) for _ in range(6000))
    check(library, [hexa, f"a {code} b {hexa[:513]} c", "ab" * 4000, "a" * 9000, "the" * 3000, "日本" * 900, "😀" * 700, "=" * 5000,
                    "".join(rng.choice("etaoinshrdlu") for _ in range(5000)) + "—" * 2000])


def test_a_megabyte_without_a_blank(library):
    import base64
    import time
    text = base64.b64encode(random.Random(5).randbytes(750_000)).decode()
    enc = Encoder(piece_model_path())
    began = time.process_time()
    flat, n = enc.encode(pa.array([text]))
    assert time.process_time() - began < 30
    assert flat.tolist() == library.encode(text)


def test_kept_words_stay_bounded(monkeypatch):
    from qalake.llm import sentencepiece_codec
    monkeypatch.setattr(sentencepiece_codec, "KEPT_WORDS", 3000)
    rng = random.Random(6)
    enc, most = Encoder(piece_model_path()), 0
    for _ in range(100):
        enc.encode(pa.array([f"w{rng.randrange(200)}" + " " * rng.randint(1, 9) + f"v{rng.randrange(200)}" for _ in range(500)]))
        most = max(most, enc.store.rows)
    assert most < 3000 + 3 * 500
