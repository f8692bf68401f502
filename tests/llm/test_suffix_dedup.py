"""Removed bytes against brute force over every window."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from qalake.llm import suffix_dedup
from qalake.llm.suffix_dedup import anchors, deduplicate

from .data import documents, odd_documents, words


def brute(docs):
    """{(doc_id, text): (bytes, removed, spans, sha)}; equal rows count once."""
    seen, out = set(), {}
    for i, t in sorted({(i, t or "") for i, t in docs}, key=lambda r: (r[0] is not None, r[0] or 0)):
        b = t.encode()
        gone = bytearray(len(b))
        for s in range(len(b) - 99):
            w = b[s:s + 100]
            if w in seen:
                gone[s:s + 100] = b"\1" * 100
            seen.add(w)
        kept = bytes(x for x, g in zip(b, gone) if not g)
        runs = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out[i, t] = (len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out


def compare(spark, docs):
    """docs: distinct ids or rows equal in id and text."""
    rows = [(i, t, "en", "s", 0, 1.0, 7, "z") for i, t in docs]
    want = {i: v for (i, _), v in brute(docs).items()}
    got = deduplicate(documents(spark, rows)).collect()
    assert len(got) == len(docs)
    for r in got:
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == want[r["doc_id"]], r["doc_id"]


def passages(seed, n=150):
    rng = random.Random(seed)
    shared = [words(rng, rng.randint(12, 60)) for _ in range(6)]
    out = []
    for i in range(n):
        parts = [words(rng, rng.randint(0, 40))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(shared)
            a = rng.randint(0, 20)
            parts += [p[a:len(p) - rng.randint(0, 20)], words(rng, rng.randint(0, 20))]
        out.append((i, rng.choice([" ", ""]).join(parts)))
    return out


def test_shared_passages(spark):
    compare(spark, passages(1))


def test_buckets_split_by_window_hash(spark, monkeypatch):
    rng = random.Random(5)
    p = words(rng, 30)
    docs = [(i, words(rng, 20) + " " + p + " " + words(rng, 20)) for i in range(300)]  # its edges: 300 contexts a bucket
    compare(spark, docs)


def test_runs_and_periods(spark):
    rng = random.Random(2)
    docs = [(1, "a" * 99), (2, "a" * 100), (3, "a" * 101), (4, "ab" * 400), (5, "ba" * 300), (6, "abc" * 100 + "x" + "abc" * 60),
            (7, "é" * 49), (8, "é" * 51 + "é" * 60), (9, ""), (10, None), (11, "x" * 3000), (12, words(rng, 3000))]
    docs += [(13, docs[-1][1][5000:9000]), (14, docs[-1][1][100:300]), (15, docs[-1][1][100:199])]
    compare(spark, docs)


def test_odd_rows(spark):
    docs = [(r[0], r[1]) for r in odd_documents() if r[0] is not None]
    compare(spark, docs)
    everything = deduplicate(documents(spark)).collect()
    assert len(everything) == len(odd_documents())
    assert sum(r["doc_id"] is None for r in everything) == 2


def test_equal_ids_with_different_texts(spark):
    rng = random.Random(9)
    a, b = words(rng, 60), words(rng, 60)
    rows = [(1, a, "", "", 0, 0.0, 0, ""), (1, a, "", "", 0, 0.0, 0, ""), (1, b, "", "", 0, 0.0, 0, ""), (2, a + b, "", "", 0, 0.0, 0, "")]
    got = sorted((r["doc_id"], r["n_bytes"], r["n_removed"]) for r in deduplicate(documents(spark, rows)).collect())
    assert [g[2] for g in got if g[0] == 1] == [0, 0, 0]
    assert got[-1] == (2, len(a + b), len(a) + len(b))


def test_empty_table(spark):
    assert deduplicate(documents(spark, [])).count() == 0


@pytest.mark.parametrize("size", [99, 100, 101, 400])
def test_every_window_has_one_context(size):
    rng = random.Random(size)
    texts = ["".join(rng.choice("ab") for _ in range(size)) for _ in range(3)]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    off = np.arange(4) * size
    row, lo, shift, more, _, _ = anchors(data, off)
    got = sorted((r, s) for r, a, m in zip(row, lo, more) for s in range(a, a + m + 1))
    assert got == [(i, i * size + s) for i in range(3) for s in range(size - 99)]
    assert (shift <= suffix_dedup.REACH).all() and (shift >= more).all()


def test_kept_bytes(spark):
    rng = random.Random(4)
    a = words(rng, 40)
    out = deduplicate(documents(spark, [(1, a, "", "", 0, 0.0, 0, ""), (2, "x " + a + " y", "", "", 0, 0.0, 0, "")]), with_bytes=True)
    assert {r["doc_id"]: bytes(r["kept"]).decode() for r in out.collect()} == {1: a, 2: "x  y"}
    assert pa.__version__
