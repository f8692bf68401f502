"""Held-out accuracy of the quality and toxicity classifiers; odd rows and labels."""

import pytest
from pyspark.sql import functions as F

from qalake.llm.quality import document_statistics, keep_good, quality
from qalake.llm.toxicity import toxicity

from .data import documents, odd_documents, table

SF = "/root/testdata/sf0.1"


@pytest.mark.parametrize("fn, label", [(quality, "quality"), (toxicity, "toxic")])
def test_held_out_accuracy(spark, fn, label):
    docs, labels = table(spark, SF, "documents").select("doc_id", "text"), table(spark, SF, "labels")
    out = fn(docs, labels)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    got = out.join(labels, "doc_id").where("held_out").select("score", "predicted", label).toPandas()
    assert len(got) > 300
    assert (got["predicted"] == got[label]).mean() >= 0.97
    for c in (0, 1):
        own = got[got[label] == c]
        assert (own["predicted"] == c).mean() >= 0.9
    assert got["score"].between(0, 1).all()


@pytest.mark.parametrize("fn, label, modulus, held", [(quality, "quality", 5, 0), (toxicity, "toxic", 4, 2)])
def test_odd_rows_and_labels(spark, fn, label, modulus, held):
    labels = spark.createDataFrame(
        [(i, i % 2 if i % 7 else None, None, "x") for i in range(70)] + [(None, 1, 0, "x"), (3, 0, 1, "y")],
        f"doc_id long, {label} int, other int, text string")
    got = fn(documents(spark), labels).collect()
    assert len(got) == len(odd_documents())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)
    crc = documents(spark).select("doc_id", (F.crc32(F.col("doc_id").cast("string")) % modulus == held).alias("h"))
    want = {r["doc_id"]: r["h"] for r in crc.collect() if r["doc_id"] is not None}
    assert all(r["held_out"] == want[r["doc_id"]] for r in got if r["doc_id"] is not None)
    assert fn(documents(spark, []), labels).count() == 0
    for none in (labels.where("false"), labels.where(F.col(label) == 1)):
        assert all(0 <= r["score"] <= 1 for r in fn(documents(spark), none).collect())


def test_labels_held_out_do_not_train(spark):
    docs, labels = table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels")
    for fn, label, modulus, held in ((quality, "quality", 5, 0), (toxicity, "toxic", 4, 2)):
        out = F.crc32(F.col("doc_id").cast("string")) % modulus == held
        flipped = labels.withColumn(label, F.when(out, 1 - F.col(label)).otherwise(F.col(label)))
        a = {r["doc_id"]: r["score"] for r in fn(docs, labels).collect()}
        b = {r["doc_id"]: r["score"] for r in fn(docs, flipped).collect()}
        assert a.keys() == b.keys() and all(a[k] == pytest.approx(b[k], abs=1e-9) for k in a)


def test_keep_good_drops_what_quality_rejects(spark):
    docs, labels = table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels")
    kept = keep_good(docs, labels)
    assert kept.columns == docs.columns
    want = {r["doc_id"] for r in quality(docs, labels).where("predicted = 1").collect()}
    assert {r["doc_id"] for r in kept.collect()} == want


def test_statistics_of_edge_texts():
    import numpy as np
    import pyarrow as pa
    x = document_statistics(pa.array([None, "", " ", "\n", "a", "a|b ### c\n\nD.", "é" * 9, "", "a"]))
    assert x.shape == (9, 20) and np.isfinite(x).all()
    assert (x[0] == x[1]).all() and (x[4] == x[8]).all()


def plain_grams(text):
    """The distinct character n-grams of a text, by string slices."""
    import re
    t = re.sub("[\x20\x09-\x0d]+", " ", " " + re.sub("[A-Z]", lambda m: m.group().lower(), text or "") + " ")
    return {t[i:i + n] for n in (4, 5, 6) for i in range(len(t) - n + 1)}


def bucket_of(gram):
    import numpy as np
    from qalake.llm.common import U64, mix64
    from qalake.llm.toxicity import BITS, _ODD
    h = 0
    for v in mix64((np.array([ord(c) for c in gram], U64) + U64(1)) * _ODD).tolist():
        h = (h * 0x9E3779B97F4A7C15 + v) % (1 << 64)
    return int(mix64(np.array([(h + len(gram)) % (1 << 64)], U64))[0]) >> (64 - BITS)


def test_grams_are_characters():
    import pyarrow as pa
    from qalake.llm.toxicity import document_buckets
    texts = ["", None, " ", "é", "Ünïcödé çä", "日本語 の  文章です", "😀😀 ab\tCD\n", "straße ", "a b c d", "", "x" * 9, "ÀÉ  \n zz"]
    row, bucket = document_buckets(pa.array(texts))
    got = [set(bucket[row == i].tolist()) for i in range(len(texts))]
    assert got == [{bucket_of(g) for g in plain_grams(t)} for t in texts]


def test_toxicity_against_a_plain_model(spark):
    """Counts, ratios and a logistic fit by plain numpy over sets of strings."""
    import numpy as np
    from qalake.llm import toxicity as tox
    sf = "/root/testdata/sf0.01"
    docs, labels = table(spark, sf, "documents").select("doc_id", "text"), table(spark, sf, "labels")
    train = labels.where(F.crc32(F.col("doc_id").cast("string")) % 4 != 2)
    rows = docs.join(train, "doc_id").where("toxic in (0, 1)").select("toxic", "text").collect()
    y = np.array([r["toxic"] for r in rows], float)
    sets = [{bucket_of(g) for g in plain_grams(r["text"])} for r in rows]
    n = np.zeros((2, 1 << tox.BITS))
    for c, s in zip(y, sets):
        n[int(c), sorted(s)] += 1
    n1, n0 = y.sum(), (1 - y).sum()
    p1, p0 = (n[1] + 0.5) / (n1 + 1), (n[0] + 0.5) / (n0 + 1)
    r = np.log(p1 / p0)
    r[(n.sum(0) < 5) | (np.abs(r) <= tox.Z * np.sqrt((1 - p1) / (n[1] + 0.5) + (1 - p0) / (n[0] + 0.5)))] = 0
    some = np.flatnonzero(r)
    some = some[np.lexsort((some, -np.abs(r[some])))][:tox.FEATURES]
    x = np.array([[b in s for b in some] for s in sets]) * r[some]
    w, bias, m, v = np.zeros(len(some)), 0.0, np.zeros(len(some) + 1), np.zeros(len(some) + 1)
    weigh = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    for t in range(1, 301):
        g = weigh * (1 / (1 + np.exp(-np.clip(bias + x @ w, -40, 40))) - y) / len(y)
        grad = np.append(g @ x + 1e-4 * w, g.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2
        step = 0.05 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-9)
        w, bias = w - step[:-1], bias - step[-1]
    text_of = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = toxicity(docs, labels).collect()
    for k in got[::9]:
        s = {bucket_of(g) for g in plain_grams(text_of[k["doc_id"]])}
        want = 1 / (1 + np.exp(-np.clip(bias + sum(a * b for a, b, c in zip(w, r[some], some) if c in s), -40, 40)))
        assert k["score"] == pytest.approx(want, abs=1e-6)


def test_quality_against_a_plain_discriminant(spark):
    """Moments, shrunken covariances and Mahalanobis log densities by plain numpy, with inverses instead of factors."""
    import numpy as np
    import pyarrow as pa
    sf = "/root/testdata/sf0.01"
    docs, labels = table(spark, sf, "documents").select("doc_id", "text"), table(spark, sf, "labels")
    x_of = {r["doc_id"]: document_statistics(pa.array([r["text"]]))[0] for r in docs.collect()}
    train = labels.where(F.crc32(F.col("doc_id").cast("string")) % 5 != 0).where("quality in (0, 1)").collect()
    groups = [np.array([x_of[r["doc_id"]] for r in train if r["quality"] == c]) for c in (0, 1)]
    n, k = np.array([len(g) for g in groups]), groups[0].shape[1]
    covs = [np.cov(g.T, bias=True) for g in groups]
    both = (n[0] * covs[0] + n[1] * covs[1]) / n.sum()
    terms = []
    for g, cov, size in zip(groups, covs, n):
        a = max(0.2, k / (k + size))
        cov = (1 - a) * cov + a * both
        cov = 0.95 * cov + 0.05 * np.diag(np.diag(cov)) + (1e-4 * np.trace(both) / k + 1e-9) * np.eye(k)
        terms.append((g.mean(0), np.linalg.inv(cov), np.log(size / n.sum()) - 0.5 * np.linalg.slogdet(cov)[1]))
    for r in quality(docs, labels).collect()[::7]:
        d = [c - 0.5 * (x_of[r["doc_id"]] - m) @ inv @ (x_of[r["doc_id"]] - m) for m, inv, c in terms]
        want = 1 / (1 + np.exp(-np.clip((d[1] - d[0]) / k ** 0.5, -40, 40)))
        assert r["score"] == pytest.approx(want, abs=1e-6) and r["predicted"] == int(r["score"] >= 0.3)
