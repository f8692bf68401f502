"""Embedding near-duplicates by product quantisation over coarse inverted lists.

Equal vectors are one class, which goes through the search once. Class vectors
of length 1 fall into the inverted list of the nearest coarse centroid; their
residuals are coded by subspace codebooks, with the length of the coding error
kept. Every class probes its own list and each list whose border (the bisector
of the two centroids) is nearer than ``margin`` times the link distance divided
by the root of the dimension: the step to a link partner has about that length
along any fixed direction. In a probed list, asymmetric distances come from
tables (query residual to codeword, by subspace). A row is passed over only if
its asymmetric distance exceeds the link distance by more than its coding error,
so the codes lose no link; the others are compared by exact cosine.

Lists are cut into parts, and their queries into chunks, of bounded size. A tile
(part, chunk) returns link counts per query and a spanning forest of its links,
never the pairs; components come from joins over the forests.

Centroids and codebooks are fitted on ``SAMPLE`` rows at most; every row is
indexed. Recall against brute force is in the tests.

Edge cases. Vectors that are null, empty, zero, or hold null or non-finite
components link with nothing, as do null ids (their component is null, they are
kept). Shorter vectors count as padded with zeros. Rows of equal ids are one
node, also with different vectors: a link of one is a link of all. Empty tables give empty results; other columns do not take part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qalake.llm.common import connected_components, materialize, shuffle_partitions, spanning_forest
from qalake.llm.search import finite_rows

#: Rows that centroids and codebooks are fitted on; most inverted lists; subspaces; codewords of a subspace.
SAMPLE, LISTS, SUBSPACES, CODEWORDS = 8192, 1024, 8, 64
#: Rows of a list's part at most, and at least however small the input; a chunk has four times as many queries.
PART_MOST, PART_LEAST = 4096, 64


def _kmeans(x: np.ndarray, n: int, rounds: int = 8) -> np.ndarray:
    c = x[np.linspace(0, len(x) - 1, min(n, len(x))).astype(int)].copy()
    for _ in range(rounds):
        own = (2 * x @ c.T - (c ** 2).sum(1)).argmax(1)
        total = np.zeros_like(c)
        np.add.at(total, own, x)
        count = np.bincount(own, minlength=len(c))
        c[count > 0] = total[count > 0] / count[count > 0, None]
    return c


class Index:
    """Coarse centroids and residual codebooks."""

    def __init__(self, x: np.ndarray, n_rows: int, margin: float, link: float):
        self.centroids = _kmeans(x, max(1, min(LISTS, int(n_rows ** 0.5))))
        c = self.centroids
        self.apart = np.sqrt(np.maximum((c ** 2).sum(1)[:, None] - 2 * c @ c.T + (c ** 2).sum(1), 1e-12))
        self.border = margin * link / x.shape[1] ** 0.5
        self.width = -(-x.shape[1] // SUBSPACES)
        rest = self._padded(x - c[self.lists(x)[0]])
        self.books = [_kmeans(rest[:, s], CODEWORDS) for s in range(rest.shape[1])]

    def _padded(self, r: np.ndarray) -> np.ndarray:
        out = np.zeros((len(r), SUBSPACES * self.width))
        out[:, :r.shape[1]] = r
        return out.reshape(len(r), SUBSPACES, self.width)

    def lists(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(nearest list, squared distances to all centroids)."""
        d = (x ** 2).sum(1)[:, None] - 2 * x @ self.centroids.T + (self.centroids ** 2).sum(1)
        return d.argmin(1), d

    def probes(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, list) pairs to search."""
        own, d = self.lists(x)
        at = np.arange(len(x))
        to_border = (d - d[at, own][:, None]) / (2 * self.apart[own])
        to_border[at, own] = 0
        return np.nonzero(to_border <= self.border)

    def encode(self, x: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(codes, lengths of the coding errors)."""
        rest = self._padded(x - self.centroids[own])
        codes = np.stack([(2 * rest[:, s] @ b.T - (b ** 2).sum(1)).argmax(1) for s, b in enumerate(self.books)], 1)
        near = np.stack([b[codes[:, s]] for s, b in enumerate(self.books)], 1)
        return codes.astype(np.uint8), np.sqrt(((rest - near) ** 2).sum((1, 2)))

    def asymmetric(self, x: np.ndarray, which: int, codes: np.ndarray) -> np.ndarray:
        """Distances of vectors from the decoded rows of a list, by table lookup."""
        rest = self._padded(x - self.centroids[which])
        out = np.zeros((len(x), len(codes)))
        for s, b in enumerate(self.books):
            table = (rest[:, s] ** 2).sum(1)[:, None] - 2 * rest[:, s] @ b.T + (b ** 2).sum(1)
            out += table[:, codes[:, s]]
        return np.sqrt(np.maximum(out, 0))


def _raw(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """Rows (vec_id, x): the components as bytes of doubles; null for vectors that cannot link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok, values, off = finite_rows(b.column(1))
            values = values + 0.0  # no negative zeros: equal vectors have equal bytes
            rows = [values[off[i]:off[i + 1]] if ok[i] else None for i in range(b.num_rows)]
            x = [r.tobytes() if r is not None and r.any() else None for r in rows]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(x, pa.binary())], ["vec_id", "x"])

    kind = vectors.schema[vec_id].dataType.simpleString()
    return vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).alias("embedding")).mapInArrow(
        run, f"vec_id {kind}, x binary").withColumn("x", F.when(F.col("vec_id").isNotNull(), F.col("x")))


def _units(col: pa.Array, dim: int) -> np.ndarray:
    """Vectors of length 1, padded with zeros."""
    out = np.zeros((len(col), dim))
    for i, r in enumerate(col.to_pylist()):
        v = np.frombuffer(r)
        v = v / np.abs(v).max()  # squares of huge or tiny components stay finite
        out[i, :len(v)] = v / np.sqrt(v @ v)
    return out


def near_duplicates(vectors: DataFrame, threshold: float = 0.95, vec_id: str = "vec_id", embedding: str = "embedding",
                    margin: float = 3.0) -> DataFrame:
    """One row per row: vec_id, n_links, component_id (least id reachable by links), kept."""
    spark = vectors.sparkSession
    rows = materialize(_raw(vectors, vec_id, embedding), "vectors")
    alone = rows.where("x is null").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    classes = materialize(rows.where("x is not null").groupBy("x").agg(
        F.min("vec_id").alias("cid"), F.count("*").alias("m")), "vector-classes")
    n, longest = classes.agg(F.count("*"), F.max(F.length("x"))).first()
    if not n:
        return _result(alone)
    dim, link = longest // 8, (2 - 2 * threshold) ** 0.5
    kind = classes.schema["cid"].dataType.simpleString()
    chosen = F.pmod(F.xxhash64(F.lit(5), "x"), F.lit(1 << 30)) < int((1 << 30) * min(1.0, SAMPLE / n))
    got = classes.where(chosen).select("cid", "x").toArrow()  # about SAMPLE rows
    if not got.num_rows:
        got = classes.limit(1).select("cid", "x").toArrow()
    got = got.take(pa.array(np.argsort(got.column("cid").to_numpy(), kind="stable")))
    index = spark.sparkContext.broadcast(Index(_units(got.column("x").combine_chunks(), dim), n, margin, link))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix = index.value
        for whole in batches:
            for start in range(0, whole.num_rows, 1024):
                b = whole.slice(start, 1024)
                u = _units(b.column(1), dim)
                own, _ = ix.lists(u)
                codes, error = ix.encode(u, own)
                row, probe = ix.probes(u)
                off = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=len(u))))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), b.column(2), pa.array(own.astype(np.int32)),
                     pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(error),
                     pa.ListArray.from_arrays(pa.array(off), pa.array(probe.astype(np.int32)))],
                    ["cid", "x", "m", "list", "code", "error", "probes"])

    placed = materialize(classes.select("cid", "x", "m").mapInArrow(
        place, f"cid {kind}, x binary, m long, list int, code binary, error double, probes array<int>"), "vector-lists")
    # rows and queries of each list: at most LISTS rows
    sizes = placed.groupBy("list").count().toPandas().set_index("list")["count"]
    asks = placed.select(F.explode("probes").alias("list")).groupBy("list").count().toPandas().set_index("list")["count"]
    part = int(min(PART_MOST, max(PART_LEAST, n // (2 * shuffle_partitions(spark)))))
    parts = {k: -(-int(v) // part) for k, v in sizes.items()}
    chunks = {k: -(-int(v) // (4 * part)) for k, v in asks.items()}
    split = spark.createDataFrame([(int(k), parts[k], chunks.get(k, 1)) for k in parts], "list int, parts int, chunks int")
    salt = lambda seed, n_col: F.pmod(F.xxhash64(F.lit(seed), "cid"), F.col(n_col)).cast("int")
    none = F.lit(None)
    held = (placed.join(F.broadcast(split), "list").withColumn("part", salt(1, "parts"))
            .select("list", "part", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"),
                    "cid", "x", "m", "code", "error"))
    asked = (placed.select("cid", "x", F.explode("probes").alias("list")).join(F.broadcast(split), "list")
             .withColumn("chunk", salt(2, "chunks"))
             .select("list", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "chunk", "cid", "x",
                     none.cast("long").alias("m"), none.cast("binary").alias("code"), none.cast("double").alias("error")))

    def search(t: pa.Table) -> pa.Table:
        ix = index.value
        ask = t.column("m").is_null().to_numpy()
        q, r = np.flatnonzero(ask), np.flatnonzero(~ask)
        x, cid = t.column("x").combine_chunks(), t.column("cid").to_numpy()
        uq, ur = _units(x.take(pa.array(q)), dim), _units(x.take(pa.array(r)), dim)
        m = t.column("m").combine_chunks().take(pa.array(r)).to_numpy()
        reach = link + t.column("error").combine_chunks().take(pa.array(r)).to_numpy() + 1e-6
        codes = np.frombuffer(b"".join(t.column("code").combine_chunks().take(pa.array(r)).to_pylist()),
                              np.uint8).reshape(len(r), SUBSPACES)
        which = t.column("list")[0].as_py()
        qa, ra = [], []
        for i in range(0, len(q) if len(r) else 0, 256):
            a, b = np.nonzero(ix.asymmetric(uq[i:i + 256], which, codes) <= reach)
            for k in range(0, len(a), 1 << 18):
                aa, bb = a[k:k + (1 << 18)] + i, b[k:k + (1 << 18)]
                near = np.einsum("ij,ij->i", uq[aa], ur[bb]) >= threshold
                near &= cid[q][aa] != cid[r][bb]
                qa.append(aa[near])
                ra.append(bb[near])
        qa = np.concatenate(qa) if qa else np.zeros(0, int)
        ra = np.concatenate(ra) if ra else np.zeros(0, int)
        links = np.bincount(qa, m[ra], minlength=len(q)).astype(np.int64)
        src, dst = spanning_forest(cid[q][qa], cid[r][ra])
        some = np.flatnonzero(links)
        return pa.table({"cid": np.concatenate((cid[q][some], src)),
                         "links": pa.array(np.concatenate((links[some], np.zeros(len(src), np.int64)))),
                         "other": pa.array(np.concatenate((np.zeros(len(some), cid.dtype), dst)),
                                           mask=np.arange(len(some) + len(src)) < len(some))})

    found = materialize(held.unionByName(asked).groupBy("list", "part", "chunk").applyInArrow(
        search, f"cid {kind}, links long, other {kind}"), "vector-links")
    counts = found.where("other is null").groupBy("cid").agg(F.sum("links").alias("links"))
    links = found.where("other is not null").select("cid", "other")
    parts_of = connected_components(links.unionByName(_same_id(rows, classes)), "cid", "other")
    done = (classes.join(counts, "cid", "left").join(parts_of.withColumnRenamed("node", "cid"), "cid", "left")
            .select(F.col("x").alias("_x"), (F.coalesce("links", F.lit(0)) + F.col("m") - 1).alias("n_links"),
                    F.coalesce("component", "cid").alias("component_id")))
    linked = rows.where("x is not null").join(done, F.col("x") == F.col("_x")).select("vec_id", "n_links", "component_id")
    return _result(linked.unionByName(alone))


def _same_id(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """Edges (cid, other) between the classes of an id that stands on different vectors."""
    usable = rows.where("x is not null")
    several = usable.groupBy("vec_id").agg(F.min("x").alias("low"), F.max("x").alias("high")).where("low <> high").select("vec_id")
    own = usable.join(several, "vec_id").distinct().join(classes.select("x", "cid"), "x")
    return own.where("cid <> vec_id").select("cid", F.col("vec_id").alias("other"))


def _result(rows: DataFrame) -> DataFrame:
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))
    return rows.select("vec_id", "n_links", "component_id", kept.alias("kept"))
