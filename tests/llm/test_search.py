"""Exact top-k against brute force: ties, copies, null and non-finite components, few rows."""

import math
import random

from pyspark.sql import functions as F

from qalake.llm.search import top_k

SCHEMA = "vec_id long, embedding array<float>, label int, score double, v string"


def brute(rows, k=5):
    ok = {}
    for i, e, *_ in rows:
        if i is not None and e is not None and all(x is not None and math.isfinite(x) for x in e):
            ok.setdefault((i, tuple(math.floor(256 * x) for x in e)), None)
    out = {}
    for q, a in ok:
        if q % 50 == 0:
            s = sorted(((-sum(x * y for x, y in zip(a, b)), i) for i, b in ok if i != q))[:k]
            out[q] = [(i, -t) for t, i in s]
    return out


def run(spark, rows, k=5):
    got = {}
    for r in top_k(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 50 == 0, k).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    return {q: [v[i] for i in sorted(v)] for q, v in got.items()}


def vectors(n, seed=1, dim=6):
    rng = random.Random(seed)
    import numpy as np
    hot = [float(np.float32(rng.gauss(0, 1))) for _ in range(dim)]
    out = []
    for i in range(n):
        e = hot if i % 3 == 0 else [float(np.float32(rng.gauss(0, 1))) for _ in range(dim)]
        out.append((i, e, 0, 0.5, "x"))
    return out


def test_ties_copies_and_unusable_rows(spark):
    rows = vectors(700)
    rows += [(None, rows[1][1], 0, 0.5, "x"), (1000, None, 0, 0.5, "x"), (1050, [1.0, None, 1.0], 0, 0.5, "x"),
             (1100, [float("nan")] * 6, 0, 0.5, "x"), (1150, [float("inf")] * 6, 0, 0.5, "x"),
             (1200, [], 0, 0.5, "x"), (1250, [3.0, 1.0], 0, 0.5, "x"), (1300, [1e5] * 6, None, None, None), rows[5], rows[50]]
    assert run(spark, rows) == brute(rows)


def test_table(spark):
    rows = [tuple(r) + (0.5, "x") for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()]
    assert run(spark, rows) == brute(rows)


def test_few_rows_and_empty_table(spark):
    rows = vectors(3)
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows[:1]) == {}
    assert run(spark, []) == {}
    assert run(spark, vectors(120), k=200) == brute(vectors(120), k=200)
