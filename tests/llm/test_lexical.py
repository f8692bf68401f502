"""Ranking against a plain evaluation; the graph of shared sums; blocks; odd rows."""

import math
import random
import re
from collections import Counter

import numpy as np

from qalake.llm import lexical
from qalake.llm.lexical import SharedSums, search

from .data import documents, odd_documents, words

TERM = "[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+"


def terms(text):
    return re.findall(TERM, re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(items, docs, k):
    """(item, rank, doc, score) rows by the contract's sums; rows are documents and items of their own."""
    held = [(i, Counter(terms(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n_docs, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scored = []
        for doc, c in held:
            m = 10 + 90 * sum(c.values()) * n_docs // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 8 * m))
                    for t in set(terms(text)) if t in c)
            if s > 0:
                scored.append((-s, doc is None, doc, s))
        scored.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(item, r + 1, doc, s) for r, (_, _, doc, s) in enumerate(scored[:k])]
    return sorted(out, key=str)


def some_items(seed=4):
    rng = random.Random(seed)
    base = words(rng, 30).split()
    items = [(i, " ".join(rng.sample(base, rng.randint(1, 20)) + words(rng, 3).split())) for i in range(40)]
    return items + [(40, None), (41, ""), (42, "!? --"), (43, "É é ÀB ab"), (44, "AB, ab. aB"), (5, "le qu"), (45, items[0][1])]


def test_against_plain_evaluation(spark, monkeypatch):
    rows = odd_documents(n=120) + [(500, "Éa é àb AB ab", "en", "s", 0, 1.0, 7, "z"), (501, "le qu qu", "en", "s", 0, 1.0, 7, "z"),
                                   (502, "le qu qu", "en", "s", 0, 1.0, 7, "z")]
    items = some_items()
    want = brute(items, [r[:2] for r in rows], 10)
    frame = spark.createDataFrame([(*i, 1, "x") for i in items], "item_id long, text string, doc_id long, score string")
    docs = documents(spark, rows).repartition(3)
    got = lambda: sorted(map(tuple, search(frame, docs).collect()), key=str)
    assert got() == want
    monkeypatch.setattr(lexical, "SCORED", 7)
    monkeypatch.setattr(lexical, "BLOCK_ITEMS", 12)
    monkeypatch.setattr(lexical, "PIECE", 5)
    assert got() == want


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame(some_items(), "item_id long, text string")
    assert search(none, documents(spark)).collect() == []
    assert search(some, documents(spark, [])).collect() == []
    assert search(some.where("item_id in (40, 41, 42)"), documents(spark)).collect() == []
    assert search(some, documents(spark, [])).dtypes == search(none, documents(spark)).dtypes


def test_shared_sums_are_right_and_fewer():
    rng = np.random.default_rng(3)
    groups = [list(map(int, rng.choice(300, 25, replace=False))) for _ in range(12)]
    items = [sorted({x for g in rng.choice(12, 3) for x in groups[g]} | set(map(int, rng.choice(300, 5)))) for _ in range(80)]
    graph = SharedSums(items + [[], [7]], 300)
    own = rng.integers(0, 1 << 40, (300, 9))
    sums = np.zeros((300 + len(graph.pairs), 9), np.int64)
    sums[:300] = own
    assert (graph.scores(sums) == np.array([own[s].sum(0) for s in items] + [np.zeros(9, np.int64), own[7]])).all()
    assert graph.additions() < 0.5 * sum(len(s) - 1 for s in items)
