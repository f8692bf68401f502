"""Quality classifier: a regularised quadratic discriminant over document statistics.

Every text becomes a fixed vector of transformed statistics (lengths, shares of
character classes, word and line repetition). Each class of the labelled rows has
a mean and a covariance that is shrunk towards the pooled covariance and towards
its own diagonal. A score is the logistic of the difference of the classes' log
densities, from Mahalanobis distances through the Cholesky factors, which are
computed once on the driver and shipped with the scoring function.

The class moments are sums that Spark aggregates, over every training row.

Edge cases. Null and empty texts have the statistics of an empty text and get a
score like any other. Rows whose label is null do not train; several labels of
one id all count. If a class has fewer than two training rows, every score is
the smoothed share of class 1. Rows of equal ids are scored one by one, empty
tables give empty results, and other columns do not take part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qalake.llm.common import TEXT_ROWS, U64, gathered, materialize, prefix_sums, span_hashes, utf8_bytes, word_spans, BYTE_VALUES

FEATURES = ("bytes", "words", "word_length", "word_length_spread", "punctuation", "symbols", "digits", "upper",
            "space", "non_ascii", "bars", "symbol_runs", "marked_words", "distinct_words", "short_words",
            "long_words", "lines", "distinct_lines", "capital_words", "ends")


def _table(chars: str) -> np.ndarray:
    t = np.zeros(256, np.uint8)
    t[list(chars.encode())] = 1
    return t


_DIGIT, _UPPER = _table("0123456789"), _table("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_PUNCT, _END = _table(".,;:!?'\"()-"), _table(".!?")
_SYMBOL = _table("#$%&*+/<=>@[\\]^_`{|}~")
_BAR, _NEWLINE, _SPACE = _table("|"), _table("\n"), _table(" \t\n\x0b\x0c\r")
_HIGH = (np.arange(256) >= 128).astype(np.uint8)


def _sums(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Sums of a byte array per row."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return (total[off[1:]] - total[off[:-1]]).astype(float)


def _distinct(rows: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """Distinct hashes per row."""
    bits = max(1, int(n).bit_length())
    key = np.sort(rows.astype(U64) << U64(64 - bits) | hashes >> U64(bits))
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    return np.bincount((key[new] >> U64(64 - bits)).astype(np.int64), minlength=n).astype(float)


def document_statistics(texts: pa.Array) -> np.ndarray:
    """The feature matrix of a column of texts."""
    data, off = utf8_bytes(texts)
    n = len(off) - 1
    size = np.diff(off).astype(float)
    start, end = word_spans(data, off)
    row = np.searchsorted(off, start, side="right") - 1
    words = np.bincount(row, minlength=n).astype(float)
    length = (end - start).astype(float)
    per = lambda x: np.bincount(row, x, minlength=n) / np.maximum(words, 1)
    mean = per(length)
    share = lambda t: _sums(t[data], off) / np.maximum(size, 1)
    sums = prefix_sums(BYTE_VALUES[data])
    symbol = _SYMBOL[data]
    runs = symbol.copy()
    runs[1:] &= symbol[:-1]
    inner = off[1:-1]
    runs[inner[inner < len(runs)]] = 0
    first, last = data[start] if len(start) else data[:0], data[end - 1] if len(end) else data[:0]
    nl = np.flatnonzero(data == 10)
    ls = np.unique(np.concatenate((off[:-1][size > 0], nl + 1)))
    ls = ls[ls < len(data)]
    le = np.concatenate((ls[1:], [len(data)]))[:len(ls)]
    lrow = np.searchsorted(off, ls, side="right") - 1
    lines = np.bincount(lrow, minlength=n).astype(float) if len(ls) else np.zeros(n)
    root = lambda x: np.arcsin(np.sqrt(np.clip(x, 0, 1)))  # noqa: E731  steadies the spread of shares
    cols = [
        np.log1p(size), np.log1p(words), np.log1p(mean),
        np.log1p(np.sqrt(np.maximum(per(length ** 2) - mean ** 2, 0))),
        root(share(_PUNCT)), root(share(_SYMBOL)), root(share(_DIGIT)), root(share(_UPPER)), root(share(_SPACE)),
        root(share(_HIGH)), root(share(_BAR)), root(_sums(runs, off) / np.maximum(size, 1)),
        root(per(_SYMBOL[last].astype(float))),
        root(_distinct(row, span_hashes(sums, start, end), n) / np.maximum(words, 1)),
        root(per((length <= 3).astype(float))), root(per((length >= 12).astype(float))),
        np.log1p(lines), root(_distinct(lrow, span_hashes(sums, ls, le), n) / np.maximum(lines, 1)),
        root(per(_UPPER[first].astype(float))), root(per(_END[last].astype(float))),
    ]
    return np.stack(cols, 1)


def statistics(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, features)."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in gathered(batches, "text"):
            x = document_statistics(b.column(1))
            off = np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.ListArray.from_arrays(pa.array(off), pa.array(x.ravel()))], ["doc_id", "features"])

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, f"doc_id {kind}, features array<double>")


def id_remainder(doc_id: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus`` (a null id counts as empty text)."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % modulus


@dataclass
class Discriminant:
    """Class means, Cholesky factors of the inverse covariances, log densities' constants."""

    means: list[np.ndarray]
    factors: list[np.ndarray]
    consts: list[float]
    share: float

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.factors:
            return np.full(len(x), self.share)
        d = [c - 0.5 * np.square((x - m) @ f.T).sum(1) for m, f, c in zip(self.means, self.factors, self.consts)]
        return 1 / (1 + np.exp(-np.clip((d[1] - d[0]) / x.shape[1] ** 0.5, -40, 40)))


def fit(stats: DataFrame, labels: DataFrame, label: str = "quality", pooled: float = 0.2,
        diagonal: float = 0.05) -> Discriminant:
    """Fit on the rows of ``stats`` whose ids ``labels`` (doc_id, ``label``) has; all of them train."""
    k = len(FEATURES)
    rows = (labels.select("doc_id", F.col(label).cast("int").alias("y")).where("y in (0, 1)")
            .join(stats, "doc_id").select("y", "features"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s, ss = np.zeros(2), np.zeros((2, k)), np.zeros((2, k, k))
        for b in batches:
            y = b.column(0).to_numpy()
            x = b.column(1).flatten().to_numpy().reshape(-1, k)
            for c in (0, 1):
                z = x[y == c]
                n[c] += len(z)
                s[c] += z.sum(0)
                ss[c] += z.T @ z
        for c in (0, 1):
            v = np.concatenate(([n[c]], s[c], ss[c].ravel()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(v), c, np.int32)), pa.array(np.arange(len(v), dtype=np.int32)), pa.array(v)],
                ["y", "i", "v"])

    got = rows.mapInArrow(run, "y int, i int, v double").groupBy("y", "i").agg(F.sum("v").alias("v")).toPandas()
    v = np.zeros((2, 1 + k + k * k))  # the moments: bounded by the number of features
    v[got["y"], got["i"]] = got["v"]
    n = v[:, 0]
    share = float((n[1] + 1) / (n.sum() + 2))
    if (n < 2).any():
        return Discriminant([], [], [], share)
    means = v[:, 1:k + 1] / n[:, None]
    covs = v[:, k + 1:].reshape(2, k, k) / n[:, None, None] - means[:, :, None] * means[:, None, :]
    both = (covs * n[:, None, None]).sum(0) / n.sum()
    floor = 1e-4 * np.trace(both) / k + 1e-9
    out = Discriminant([], [], [], share)
    for c in (0, 1):
        small = k / (k + n[c])  # few rows: nearer to the pooled covariance
        a = max(pooled, small)
        cov = (1 - a) * covs[c] + a * both
        cov = (1 - diagonal) * cov + diagonal * np.diag(np.diag(cov)) + floor * np.eye(k)
        low = np.linalg.cholesky(cov)
        out.means.append(means[c])
        out.factors.append(np.linalg.inv(low))
        out.consts.append(float(np.log(n[c] / n.sum()) - np.log(np.diag(low)).sum()))
    return out


def score(stats: DataFrame, model: Discriminant) -> DataFrame:
    """Rows (doc_id, score)."""
    kind, k = stats.schema["doc_id"].dataType.simpleString(), len(FEATURES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column(1).flatten().to_numpy().reshape(-1, k)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.score(x))], ["doc_id", "score"])

    return stats.select("doc_id", "features").mapInArrow(run, f"doc_id {kind}, score double")


def quality(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
            modulus: int = 5, held_out: int = 0, threshold: float = 0.3) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted; learns only from labels that are not held out."""
    stats = materialize(statistics(docs, doc_id, text), "quality-statistics", TEXT_ROWS)
    train = labels.where(id_remainder("doc_id", modulus) != held_out)
    out = score(stats, fit(stats, train, label))
    return out.select("doc_id", (id_remainder("doc_id", modulus) == held_out).alias("held_out"), "score",
                      (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
              threshold: float = 0.3, **options) -> DataFrame:
    """The documents whose score reaches the threshold, with all their columns; scored in one pass over the texts."""
    stats = materialize(statistics(docs, doc_id, text), "quality-statistics", TEXT_ROWS)
    modulus, held_out = options.get("modulus", 5), options.get("held_out", 0)
    model = fit(stats, labels.where(id_remainder("doc_id", modulus) != held_out), options.get("label", "quality"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in gathered(batches, text):
            keep = model.score(document_statistics(b.column(text))) >= threshold
            yield b.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
