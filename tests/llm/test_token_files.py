"""Ids equal the library's on whole texts; the files give them back in order."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from qalake.llm.token_files import WordEncoder, decode_ranks, encode_ranks, token_files

from .data import documents, odd_documents

tokenizers = pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = str(public_tokenizers.path("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(PATH)


def test_words_give_the_ids_of_whole_texts(library):
    rng = random.Random(1)
    texts = ["", " ", "a.", "It's.,x", "<|ENDOFTEXT|> <|endoftext|>.", "İ.", "é. é. É,", "ab\ncd\t ef gh", "don't 's.",
             "1.5, 2,3.", "日本.", "x̀.,", "a..b,,c.", "ſ. ß.", "<|startoftext|>abc", "x<|endoftext|>Y."]
    texts += ["".join(rng.choice("abT' .,<|>\n\té1éİ") for _ in range(rng.randint(0, 30))) for _ in range(2000)]
    enc = WordEncoder(PATH)
    flat, n = enc.encode(pa.array(texts))
    at = np.concatenate(([0], np.cumsum(n)))
    for i, e in enumerate(library.encode_batch(texts, add_special_tokens=False)):
        assert flat[at[i]:at[i + 1]].tolist() == e.ids, texts[i]


def test_variable_length_code_round_trip():
    rng = np.random.default_rng(0)
    for counts in ([0, 1, 3, 4, 5, 0, 1000], [0], [7]):
        counts = np.array(counts)
        ranks = (rng.integers(0, 1 << 32, counts.sum()) >> rng.integers(0, 32, counts.sum())).astype(np.uint32)
        control, n_control, data, n_data = encode_ranks(ranks, counts)
        assert len(control) == n_control.sum() == ((counts + 3) // 4).sum() and len(data) == n_data.sum()
        assert (decode_ranks(control, counts, data) == ranks).all()


def test_files_of_the_table(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    start = 0
    got = {r["doc_id"]: r for r in token_files(docs, PATH, 1, with_ids=True).collect()}
    for r in docs.orderBy("doc_id").collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids + [1]
        g = got[r["doc_id"]]
        assert (g["start"], g["n_tokens"], g["ids"]) == (start, len(ids), ids)
        assert g["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    assert len(got) == docs.count()


def test_odd_rows_and_empty_table(spark, library):
    rows = token_files(documents(spark), PATH, 1, with_ids=True).collect()
    assert len(rows) == len(odd_documents())
    rows.sort(key=lambda r: r["start"])
    assert [r["start"] for r in rows] == [0, *np.cumsum([r["n_tokens"] for r in rows])[:-1].tolist()]
    assert [r["doc_id"] for r in rows] == sorted((r["doc_id"] for r in rows), key=lambda i: (i is not None, i))
    texts = {r[0]: r[1] for r in odd_documents() if r[0] is not None}
    for r in rows:
        if r["doc_id"] is not None:
            assert r["ids"] == library.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids + [1]
    assert token_files(documents(spark, []), PATH, 1).count() == 0
