"""Toxicity: a linear classifier of character n-grams scaled by naive Bayes log-count ratios.

Texts are lower-cased (A-Z) code points with runs of white space as one blank and
a blank at either end. Their n-grams of ``SIZES`` characters fall into 2**BITS buckets.
From the training rows each bucket gets the log ratio of its smoothed document
shares in the two classes; buckets whose ratio stands out of its sampling error
(``Z``) are features (``FEATURES`` at most), with that ratio as their value where a text has the bucket.
A logistic model over the features is fitted by gradient descent.

Training looks at ``TRAIN_ROWS`` labelled rows of each class at most (those with
the smallest hashes of their ids), a bound on the driver's work. Scores look at
every n-gram of every whole text.

Edge cases. Null and empty texts have the n-grams of a blank. Rows whose label is
null do not train. If a class has no training row, every score is the smoothed
share of class 1. Rows of equal ids are scored one by one, empty tables give
empty results, and other columns do not take part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qalake.llm.common import SPACE_BYTES, U64, gathered, materialize, mix64, utf8_bytes
from qalake.llm.quality import id_remainder

SIZES, BITS = (4, 5, 6), 20
#: Labelled rows of each class that train at most.
TRAIN_ROWS = 6000
#: Standard errors by which a bucket's log ratio must differ from 0.
Z = 4.0
#: Features of a model at most: the significant buckets of the greatest ratios.
FEATURES = 8192

_LOWER = np.arange(128, dtype=np.uint32)
_LOWER[65:91] += 32
_LOWER[np.flatnonzero(SPACE_BYTES[:128])] = 32
_ODD = U64(0xD1342543DE82EF95)


def _characters(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(code points, A-Z lower-cased and white space as blanks; row offsets)."""
    data, off = utf8_bytes(texts)
    before = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))  # characters that start before each byte
    points = np.frombuffer(data.tobytes().decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32).copy()
    plain = points < 128
    points[plain] = _LOWER[points[plain]]
    return points, before[off]


def _grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, Iterator[np.ndarray]]:
    """(normal characters, row offsets, buckets of the n-grams at each character, one array per size)."""
    data, off = _characters(texts)
    n = len(off) - 1
    # a blank before each text and one behind the last: every text stands between blanks
    own = np.full(len(data) + n + 1, 32, np.uint32)
    at = np.arange(len(data)) + np.repeat(np.arange(1, n + 1), np.diff(off))
    own[at] = data
    start = off[:-1] + np.arange(n)
    blank = own == 32
    keep = np.ones(len(own), bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    keep[start] = True
    place = np.cumsum(keep) - 1
    own, off = own[keep], np.append(place[start], keep.sum())
    value = mix64((own.astype(U64) + U64(1)) * _ODD)

    def each() -> Iterator[np.ndarray]:
        for size in SIZES:
            h = np.zeros(max(len(own) - size + 1, 0), U64)
            for k in range(size):
                h *= U64(0x9E3779B97F4A7C15)
                h += value[k:len(own) - size + 1 + k]
            yield (mix64(h + U64(size)) >> U64(64 - BITS)).astype(np.int32)

    return own, off, each()


def document_buckets(texts: pa.Array, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(rows, buckets): the distinct buckets of each text; only those that ``wanted`` marks, if given."""
    own, off, each = _grams(texts)
    n = len(off) - 1
    closed = (own[off[1:] - 1] != 32).astype(np.int64)  # a text that ends in a blank has its closing one
    rows, found = [], []
    for size, bucket in zip(SIZES, each):
        at = np.flatnonzero(wanted[bucket]) if wanted is not None else np.arange(len(bucket))
        row = np.searchsorted(off, at, side="right") - 1
        end = off[np.minimum(row + 1, n)]
        inside = at + size <= end + closed[np.minimum(row, n - 1)]  # the blank that opens the next text closes this one
        rows.append(row[inside])
        found.append(bucket[at[inside]])
    key = np.unique(np.concatenate(rows).astype(np.int64) << BITS | np.concatenate(found))
    return key >> BITS, key & (1 << BITS) - 1


@dataclass
class Classifier:
    """A weight per bucket (0: no feature) and a bias."""

    weight: np.ndarray
    bias: float

    def score(self, texts: pa.Array) -> np.ndarray:
        row, bucket = document_buckets(texts, self.weight != 0)
        z = self.bias + np.bincount(row, self.weight[bucket], minlength=len(texts))
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def training_rows(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str) -> DataFrame:
    """(y, text) of at most TRAIN_ROWS rows of each class, chosen by the hash of the id."""
    y = labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("y")).where("y in (0, 1)")
    # the hash that about TRAIN_ROWS rows of a class lie below; the rows below it are joined, the rest never move
    h = F.pmod(F.xxhash64(F.lit(17), "_id"), F.lit(1 << 30)) / float(1 << 30)
    counts = {r["y"]: r["n"] for r in y.groupBy("y").agg(F.count("*").alias("n")).collect()}
    share = F.lit(0.0)
    for c, n in counts.items():
        share = F.when(F.col("y") == c, min(1.0, TRAIN_ROWS / n)).otherwise(share)
    chosen = y.where(h < share)
    chosen = chosen.withColumn("_h", F.xxhash64(F.lit(18), "_id"))
    zero, one = (chosen.where(F.col("y") == c).orderBy("_h", "_id").limit(TRAIN_ROWS).select("_id", "y") for c in (0, 1))
    chosen = zero.unionAll(one)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return rows.join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).select("y", "text")


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
        steps: int = 300, penalty: float = 1e-4) -> Classifier:
    """Fit on labelled rows (see TRAIN_ROWS): bucket statistics on Spark, the logistic model on the driver."""

    rows = materialize(training_rows(docs, labels, doc_id, text, label), "toxicity-training")
    size = 1 << BITS

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((2, size + 1), np.int64)
        for b in gathered(batches, "text"):
            y = b.column(0).to_numpy()
            row, bucket = document_buckets(b.column(1))
            for c in (0, 1):
                n[c, :size] += np.bincount(bucket[y[row] == c], minlength=size)
                n[c, size] += (y == c).sum()
        at = np.flatnonzero(n.any(0))
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[0, at]), pa.array(n[1, at])], ["bucket", "n0", "n1"])

    got = rows.mapInArrow(counts, "bucket long, n0 long, n1 long").groupBy("bucket").agg(
        F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))  # at most 2**BITS + 1 rows
    total = got.where(F.col("bucket") == size).first()
    n0, n1 = (total["n0"], total["n1"]) if total else (0, 0)
    weight = np.zeros(size)
    if not n0 or not n1:
        p = (n1 + 1) / (n0 + n1 + 2)
        return Classifier(weight, float(np.log(p / (1 - p))))
    # log ratio of the smoothed shares, and its standard error
    p1, p0 = (F.col("n1") + 0.5) / (n1 + 1), (F.col("n0") + 0.5) / (n0 + 1)
    error = F.sqrt((1 - p1) / (F.col("n1") + 0.5) + (1 - p0) / (F.col("n0") + 0.5))
    feats = (got.where((F.col("bucket") < size) & (F.col("n0") + F.col("n1") >= 5))
             .withColumn("r", F.log(p1 / p0)).where(F.abs("r") > Z * error)
             .orderBy(F.abs("r").desc(), "bucket").limit(FEATURES).select("bucket", "r").toPandas())
    ratio = np.zeros(size)
    ratio[feats["bucket"]] = feats["r"]
    known = ratio != 0

    def only(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in gathered(batches, "text"):
            row, bucket = document_buckets(b.column(1), known)
            off = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=b.num_rows)))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.ListArray.from_arrays(pa.array(off), pa.array(bucket.astype(np.int32)))],
                ["y", "buckets"])

    train = rows.mapInArrow(only, "y int, buckets array<int>").toArrow()  # 2 * TRAIN_ROWS rows of features
    col = train.column("buckets").combine_chunks()
    y = train.column("y").to_numpy().astype(float)
    bucket = col.flatten().to_numpy()
    k = np.diff(col.offsets.to_numpy())
    row = np.repeat(np.arange(len(y)), k)
    bias, w = _logistic(row, bucket, ratio, y, n1 / (n0 + n1), steps, penalty)
    weight[:] = w * ratio
    return Classifier(weight, bias)


def _logistic(row: np.ndarray, bucket: np.ndarray, ratio: np.ndarray, y: np.ndarray, share: float,
              steps: int, penalty: float) -> tuple[float, np.ndarray]:
    """Bias and weights of the scaled features, by Adam on the whole (bounded) training set."""
    used, where = np.unique(bucket, return_inverse=True)
    x = ratio[used][where]
    w, bias = np.zeros(len(used)), float(np.log(share / (1 - share)))
    weigh = np.where(y == 1, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))  # the classes count alike
    m, v = np.zeros(len(used) + 1), np.zeros(len(used) + 1)
    bias = 0.0
    for t in range(1, steps + 1):
        z = bias + np.bincount(row, w[where] * x, minlength=len(y))
        g = weigh * (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y) / len(y)
        grad = np.append(np.bincount(where, g[row] * x, minlength=len(used)) + penalty * w, g.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2
        step = 0.05 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-9)
        w, bias = w - step[:-1], bias - step[-1]
    out = np.zeros(len(ratio))
    out[used] = w
    return float(bias), out


def toxicity(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
             modulus: int = 4, held_out: int = 2, threshold: float = 0.3) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted; learns only from labels that are not held out."""
    model = fit(docs, labels.where(id_remainder("doc_id", modulus) != held_out), doc_id, text, label)
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in gathered(batches, "text"):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.score(b.column(1)))], ["doc_id", "score"])

    out = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, f"doc_id {kind}, score double")
    return out.select("doc_id", (id_remainder("doc_id", modulus) == held_out).alias("held_out"), "score",
                      (F.col("score") >= threshold).cast("int").alias("predicted"))
