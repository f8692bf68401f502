"""Counts, near words, forms and roots against plain evaluation; odd rows."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from qalake.llm.spelling import checksums, near_pairs, variants, word_counts, word_signatures

from .data import documents, odd_documents, words

RUN = "[A-Za-zÀ-ÿ]+"


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text)


def counts(rows, damage, letters=5):
    out = Counter()
    for i, t in rows:
        for w in re.findall(RUN, lower(t or "")):
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if damage and h % damage == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            if len(w) >= letters:
                out[w] += 1
    return out


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(n, times=2):
    form, out = {}, {}
    for w in n:
        own = sorted((v for v in n if near(w, v)), key=lambda v: (-n[v], v))
        form[w] = own[0] if own and n[own[0]] >= times * n[w] else None
        out[w] = len(own)
    rows = {}
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        rows[w] = (form[w], root, n[w], out[w], n[form[w]] if form[w] else None)
    return rows


def texts(seed=6, n=300):
    rng = random.Random(seed)
    vocabulary = words(rng, 120).split() + ["Straße", "éàÿçö", "ÀÉÎÕÜ", "über×÷", "naïveté"]
    out = []
    for i in range(n):
        line = []
        for _ in range(30):
            w = vocabulary[min(int(rng.expovariate(0.05)), len(vocabulary) - 1)]
            if rng.random() < 0.3 and len(w) > 2:
                k = rng.randrange(len(w))
                w = rng.choice([w[:k] + w[k + 1:], w[:k] + rng.choice("aeéÿ") + w[k:], w[:k] + rng.choice("bcü") + w[k + 1:]])
            line.append(rng.choice([w, w.capitalize(), w.upper()]))
        out.append((i, rng.choice([" ", "1", "-", "ʼ", "Ā"]).join(line)))
    return out


@pytest.mark.parametrize("damage", [97, 3, None])
def test_against_plain_evaluation(spark, damage):
    rows = texts() + [r[:2] for r in odd_documents()]
    frame = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, n long, word string").repartition(3)
    want = counts(rows, damage)
    assert {r["word"]: r["n"] for r in word_counts(frame, damage).collect()} == want
    kept = {w: n for w, n in want.items() if n >= 3}
    got = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in variants(frame, damage).collect()}
    assert got == brute(kept)
    assert any(r[1] != r[0] and r[0] for r in got.values())  # some chain has two steps


def test_every_near_pair_shares_a_signature(spark):
    rng = random.Random(1)
    pool = {"".join(rng.choice("abé") for _ in range(rng.randint(1, 6))) for _ in range(400)}
    pairs = {(a, b) for a in pool for b in pool if a < b and near(a, b)}
    frame = spark.createDataFrame([(w, 1) for w in pool], "word string, n long")
    got = [(r["a"], r["b"]) for r in near_pairs(frame).collect()]
    assert len(got) == len(set(got)) and {tuple(sorted(p)) for p in got} == pairs
    assert len(list(word_signatures("abcdef"))) == 12


def test_long_chain_of_forms(spark):
    rows = [(i, " ".join(["abcdefghij"[:0] + "q" * (5 + i)] * (3 * 2 ** (9 - i)))) for i in range(10)]
    got = {r["word"]: r["root"] for r in variants(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert set(got.values()) == {"qqqqq"} and len(got) == 10


def test_checksums():
    data = np.frombuffer(b"abcdefghijklmnop", np.uint8)
    start, end = np.array([0, 3, 5, 5]), np.array([16, 3, 6, 12])
    before = np.array([zlib.crc32(b"7:"), 0, zlib.crc32(b"x"), 5], np.uint32)
    assert checksums(data, start, end, before).tolist() == [zlib.crc32(bytes(data[a:b]), int(c)) for a, b, c in zip(start, end, before)]


def test_odd_rows(spark):
    got = variants(documents(spark), 97, least=1).collect()
    want = brute(dict(counts([r[:2] for r in odd_documents()], 97)))
    assert {r["word"]: r["root"] for r in got} == {w: r[1] for w, r in want.items()}
    assert variants(documents(spark, []), 97).collect() == []
    assert variants(spark.createDataFrame([(None, None), (1, "")], "doc_id long, text string"), 97).collect() == []
