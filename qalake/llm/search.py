"""Exact top-k inner-product search by a pivot-distance index.

Vectors are whole numbers (see ``quantise``). One added coordinate,
sqrt(M^2 - |v|^2) for the rows and 0 for the queries, makes the greatest inner
product the least Euclidean distance: d^2 = |q|^2 + M^2 - 2 q.v. Every row is
keyed by its nearest pivot and its distance from it, and the distances of a pivot
are cut into annuli at approximate percentiles. The triangle inequality bounds
the distance of a query from all rows of an annulus, and of any part of it.

First every query finds its k-th best score among the rows beside it; that
score then rules out annuli, and the query goes to the others only. There the
rows are sorted by distance and taken in rings from the query's own distance
outwards until the bound of the next ring falls below its k-th best score.
Bounds carry a slack for rounding; scores are exact.

Annuli are split into blocks of bounded size, so a common vector is no hot
block; queries meet blocks in bounded chunks. Only pivots, block bounds (both of
fixed number) and counts reach the driver.

Edge cases. Vectors that are null or hold null or non-finite components take no
part, nor do null ids. Shorter vectors count as padded with zeros. Repeated rows
count once; a row never answers a query of its own id. Equal scores go to the
smaller id. Queries with fewer than k other rows return all. Empty tables give
empty results, and other columns do not take part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qalake.llm.common import materialize, shuffle_partitions

#: Pivots, annuli of a pivot, rows that the pivots are chosen from, queries of a chunk, rows of a ring.
PIVOTS, ANNULI, PIVOT_ROWS, CHUNK, RING = 16, 8, 4096, 4096, 256
#: Rows of a block at most, and at least however small the input.
BLOCK_MOST, BLOCK_LEAST = 65536, 64


def finite_rows(col: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(usable, flat values, offsets) of a list column; unusable rows are null or hold null, NaN or infinity."""
    values = col.flatten().to_numpy(zero_copy_only=False).astype(float)  # nulls become NaN
    n = np.asarray([0 if x is None else x for x in col.value_lengths().to_pylist()], np.int64)
    off = np.concatenate(([0], np.cumsum(n)))
    bad = np.concatenate(([0], np.cumsum(~np.isfinite(values))))
    usable = col.is_valid().to_numpy(zero_copy_only=False) & (bad[off[1:]] == bad[off[:-1]])
    return usable, values, off


def quantise(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", scale: float = 256.0) -> DataFrame:
    """Rows (vec_id, v, dim, norm2, top): floor(scale * x) as 64-bit integers, distinct, usable rows only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok, values, off = finite_rows(b.column(1))
            x = np.floor(scale * values)
            ids, v, dim, norm, top = [], [], [], [], []
            names = b.column(0).to_pylist()
            for i in np.flatnonzero(ok).tolist():
                row = x[off[i]:off[i + 1]]
                ids.append(names[i])
                v.append(row.astype(np.int64).tobytes())
                dim.append(len(row))
                norm.append(float(row @ row))
                top.append(float(np.abs(row).max()) if len(row) else 0.0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(v, pa.binary()), pa.array(dim, pa.int32()),
                 pa.array(norm, pa.float64()), pa.array(top, pa.float64())], ["vec_id", "v", "dim", "norm2", "top"])

    src = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("embedding"))
    return src.where("vec_id is not null").mapInArrow(
        run, "vec_id long, v binary, dim int, norm2 double, top double").dropDuplicates(["vec_id", "v"])


def matrix(col: pa.Array, dim: int) -> np.ndarray:
    """The integer vectors of a binary column as rows, padded with zeros."""
    rows = col.to_pylist()
    if all(len(r) == 8 * dim for r in rows):
        return np.frombuffer(b"".join(rows), np.int64).reshape(len(rows), dim)
    out = np.zeros((len(rows), dim), np.int64)
    for i, r in enumerate(rows):
        out[i, :len(r) // 8] = np.frombuffer(r, np.int64)
    return out


def _pivots(x: np.ndarray, n: int) -> np.ndarray:
    """Centres of a few rounds of k-means, from rows far apart."""
    if not len(x):
        return np.zeros((1, x.shape[1]))
    centre, d = [x[0]], np.full(len(x), np.inf)
    while len(centre) < min(n, len(x)):
        d = np.minimum(d, ((x - centre[-1]) ** 2).sum(1))
        centre.append(x[int(d.argmax())])
    c = np.array(centre)
    for _ in range(8):
        own = ((x ** 2).sum(1)[:, None] - 2 * x @ c.T + (c ** 2).sum(1)).argmin(1)
        for j in range(len(c)):
            if (own == j).any():
                c[j] = x[own == j].mean(0)
    return c


def _distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((x ** 2).sum(1)[:, None] - 2 * x @ c.T + (c ** 2).sum(1), 0))


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k greatest scores, ties to the smaller id."""
    if len(scores) > 4 * k:
        limit = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= limit)
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))[:k]]


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, vec_id: str = "vec_id", embedding: str = "embedding",
          scale: float = 256.0) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): the k best other rows of every row for which ``is_query`` holds.

    ``is_query`` is a condition on vec_id.
    """
    spark = vectors.sparkSession
    rows = materialize(quantise(vectors, vec_id, embedding, scale), "search-vectors")
    n, dim, most, top = rows.agg(F.count("*"), F.max("dim"), F.max("norm2"), F.max("top")).first()
    out_schema = "query_id long, rank int, vec_id long, score long"
    if not n:
        return spark.createDataFrame([], out_schema)
    exact = top * top * dim < 2 ** 53
    slack = 1e-9 * (most + 1.0)
    sample = rows.where(F.pmod(F.xxhash64(F.lit(5), "vec_id"), F.lit(1 << 30)) < int((1 << 30) * min(1.0, PIVOT_ROWS / n)))
    got = sample.select("vec_id", "v", "norm2").toArrow()  # about PIVOT_ROWS rows

    def lifted(v: np.ndarray, norm2: np.ndarray) -> np.ndarray:
        return np.concatenate((v, np.sqrt(np.maximum(most - norm2, 0))[:, None]), 1)

    order = np.argsort(got.column("vec_id").to_numpy(), kind="stable")
    got = got.take(pa.array(order))
    pivots = _pivots(lifted(matrix(got.column("v").combine_chunks(), dim).astype(float), got.column("norm2").to_numpy()), PIVOTS)

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = matrix(b.column(1), dim)
            d = _distances(lifted(v.astype(float), b.column(2).to_numpy()), pivots)
            p = d.argmin(1)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(p.astype(np.int32)), pa.array(d[np.arange(len(p)), p])],
                ["vec_id", "v", "pivot", "dist"])

    keyed = materialize(rows.select("vec_id", "v", "norm2").mapInArrow(
        key, "vec_id long, v binary, pivot int, dist double"), "search-keys")
    cuts = {r["pivot"]: np.unique(r["cut"]) for r in keyed.groupBy("pivot").agg(
        F.percentile_approx("dist", [i / ANNULI for i in range(1, ANNULI)]).alias("cut")).collect()}  # PIVOTS rows
    annulus = F.lit(0)
    for p, cut in cuts.items():
        inside = F.lit(0)
        for c in cut.tolist():
            inside = inside + (F.col("dist") > c).cast("int")
        annulus = F.when(F.col("pivot") == p, inside).otherwise(annulus)
    keyed = keyed.withColumn("block", F.col("pivot") * ANNULI + annulus)
    blocks = keyed.groupBy("block").agg(F.count("*").alias("n"), F.min("dist").alias("lo"), F.max("dist").alias("hi")) \
        .orderBy("block").toPandas()  # PIVOTS * ANNULI rows at most
    size = int(min(BLOCK_MOST, max(BLOCK_LEAST, n // (2 * shuffle_partitions(spark)))))
    number = blocks["block"].to_numpy()
    parts = -(-blocks["n"].to_numpy() // size)
    lo, hi = blocks["lo"].to_numpy(), blocks["hi"].to_numpy()
    n_parts = F.lit(1)
    for b, s in zip(number.tolist(), parts.tolist()):
        if s > 1:
            n_parts = F.when(F.col("block") == b, s).otherwise(n_parts)
    keyed = keyed.withColumn("part", F.pmod(F.xxhash64(F.lit(9), "vec_id"), n_parts).cast("int"))

    def scores_of(v: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Exact inner products, as 64-bit integers."""
        if exact:
            return np.rint(v.astype(float) @ q.astype(float)).astype(np.int64)
        return v @ q

    # a first k-th best score of every query, from the rows of its own block
    is_query_row = is_query.alias("query")

    def first(t: pa.Table) -> pa.Table:
        v, ids = matrix(t.column("v").combine_chunks(), dim), t.column("vec_id").to_numpy()
        at = np.flatnonzero(t.column("query").to_numpy(zero_copy_only=False))
        least = np.full(len(at), np.iinfo(np.int64).min)
        for j, i in enumerate(at.tolist()):
            other = ids != ids[i]
            if other.sum() >= k:
                s = scores_of(v[other], v[i])
                least[j] = np.partition(s, len(s) - k)[len(s) - k]
        return pa.table({"query_id": ids[at], "v": t.column("v").take(pa.array(at)).combine_chunks(), "least": least})

    seeds = keyed.select("block", "part", "vec_id", "v", is_query_row).groupBy("block", "part").applyInArrow(
        first, "query_id long, v binary, least long")
    seeds = materialize(seeds, "search-queries")
    n_queries = seeds.count()
    chunks = max(1, -(-n_queries // CHUNK))

    # the blocks that may hold a better row, by the triangle inequality
    pivot_of = number // ANNULI

    def needed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                b = whole.slice(start, 256)
                q = matrix(b.column(1), dim).astype(float)
                least = b.column(2).to_numpy().astype(float)
                d = _distances(np.concatenate((q, np.zeros((len(q), 1))), 1), pivots)[:, pivot_of]
                gap = np.maximum(np.maximum(d - hi, lo - d), 0)
                gap = np.maximum(gap - 1e-7 * (d + 1), 0)
                best = ((q ** 2).sum(1)[:, None] + most - gap ** 2) / 2
                row, col = np.nonzero(best + slack >= least[:, None])
                times = parts[col]
                row, col = np.repeat(row, times), np.repeat(col, times)
                part = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(number[col].astype(np.int32)), pa.array(part.astype(np.int32)), b.column(0).take(take),
                     b.column(1).take(take), b.column(2).take(take), pa.array(d[row, col])],
                    ["block", "part", "vec_id", "v", "least", "dist"])

    asked = seeds.mapInArrow(needed, "block int, part int, vec_id long, v binary, least long, dist double")
    asked = asked.withColumn("chunk", F.pmod(F.xxhash64(F.lit(3), "vec_id"), F.lit(chunks)).cast("int"))
    held = keyed.select(F.col("block").cast("int").alias("block"), "part", "vec_id", "v",
                        F.lit(None).cast("long").alias("least"), "dist",
                        F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"), F.lit(False).alias("query"))
    tiles = held.unionByName(asked.withColumn("query", F.lit(True)))

    def search(t: pa.Table) -> pa.Table:
        query = t.column("query").to_numpy(zero_copy_only=False)
        rows_at, asks = np.flatnonzero(~query), np.flatnonzero(query)
        dist, ids = t.column("dist").to_numpy(), t.column("vec_id").to_numpy()
        rows_at = rows_at[np.lexsort((ids[rows_at], dist[rows_at]))]
        col = t.column("v").combine_chunks()
        v, q = matrix(col.take(pa.array(rows_at)), dim), matrix(col.take(pa.array(asks)), dim)
        ring, row_ids = dist[rows_at], ids[rows_at]
        leasts = t.column("least").combine_chunks().take(pa.array(asks)).to_numpy()
        vf = v.astype(float) if exact else v
        qf = q.astype(float) if exact else q
        norms = (q.astype(float) ** 2).sum(1)
        outs = []
        for j in range(len(asks)):
            least, dq, me = int(leasts[j]), dist[asks[j]], ids[asks[j]]
            kept_ids, kept = np.zeros(0, np.int64), np.zeros(0, np.int64)
            left = right = int(np.searchsorted(ring, dq))
            while True:
                # the distance beyond which no row can reach the k-th best score
                reach = np.sqrt(max(norms[j] + most - 2 * (least - slack), 0)) * (1 + 1e-7) + 1e-6
                a = max(left - RING, int(np.searchsorted(ring, dq - reach)))
                b = min(right + RING, int(np.searchsorted(ring, dq + reach, side="right")))
                a, b = min(a, left), max(b, right)
                if a == left and b == right:
                    break
                for x, y in ((a, left), (right, b)):
                    if x < y:
                        s = vf[x:y] @ qf[j]
                        s = np.rint(s).astype(np.int64) if exact else s
                        use = (s >= least) & (row_ids[x:y] != me)
                        kept_ids, kept = np.concatenate((kept_ids, row_ids[x:y][use])), np.concatenate((kept, s[use]))
                left, right = a, b
                if len(kept) >= k:
                    best = _best(kept_ids, kept, k)
                    kept_ids, kept = kept_ids[best], kept[best]
                    least = max(least, int(kept[-1]))
            outs.append((np.full(len(kept), me), kept_ids, kept))
        cat = lambda i: np.concatenate([o[i] for o in outs]) if outs else np.zeros(0, np.int64)
        return pa.table({"query_id": cat(0), "vec_id": cat(1), "score": cat(2)})

    found = tiles.groupBy("block", "part", "chunk").applyInArrow(search, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
