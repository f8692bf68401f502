"""Shared helpers of the training-data operators.

* tables that cut lineage are written below ``spark.checkpoint.dir``;
* byte-level helpers view an Arrow string column as one numpy byte array;
* connected components run as joins and aggregates on star edges.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qalake.session import scratch_path

U64 = np.uint64
#: Bytes of text that one vectorised step looks at together.
SLICE_BYTES = 1 << 20
#: The same for steps that look words up: larger slices repeat more of them.
WORD_SLICE_BYTES = 4 << 20


#: Rows that cross to Python at once where they carry texts (Spark's default suits numbers).
TEXT_ROWS = 512
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def materialize(df: DataFrame, name: str, batch_rows: int | None = None) -> DataFrame:
    """Write ``df`` as Parquet to the shared scratch folder and read it back.

    ``batch_rows`` bounds the rows of an Arrow batch while the job runs.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    schema = df.schema
    usual = spark.conf.get(_BATCH)
    if batch_rows:
        spark.conf.set(_BATCH, str(batch_rows))
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_BATCH, usual)
    return spark.read.schema(schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_or_empty(col: str) -> F.Column:
    return F.coalesce(F.col(col), F.lit(""))


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijection of 64-bit integers."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def utf8_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; nulls count as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if pa.types.is_string(col.type) or pa.types.is_large_string(col.type):
        col = col.cast(pa.large_string()).fill_null("")
    else:
        col = col.cast(pa.large_binary()).fill_null(b"")
    n = len(col)
    off = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + n + 1] if n else np.zeros(1, np.int64)
    buf = col.buffers()[2]
    data = np.frombuffer(buf, np.uint8) if buf is not None and buf.size else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def release_memory() -> None:
    """Give freed memory back to the system: Python workers live on, idle, beside the next stage's."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def slices(batches: Iterator[pa.RecordBatch], text: str,
           limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about ``limit`` bytes of ``text`` (one row at least)."""
    for b in batches:
        if not b.num_rows:
            continue
        _, off = utf8_bytes(b.column(text))
        at = 0
        while at < b.num_rows:
            end = int(np.searchsorted(off, off[at] + limit, side="right")) - 1
            end = min(max(end, at + 1), b.num_rows)
            yield b.slice(at, end - at)
            at = end
    release_memory()


def gathered(batches: Iterator[pa.RecordBatch], text: str,
             limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Join small batches and cut large ones to about ``limit`` bytes of ``text``."""
    kept: list[pa.RecordBatch] = []
    size = 0
    for b in slices(batches, text, limit):
        kept.append(b)
        size += int(utf8_bytes(b.column(text))[1][-1])
        if size >= limit:
            yield _joined(kept)
            kept, size = [], 0
    if kept:
        yield _joined(kept)


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    if len(parts) == 1:
        return parts[0]
    t = pa.Table.from_batches(parts).combine_chunks()
    return t.to_batches()[0]


def row_of(off: np.ndarray, positions: np.ndarray) -> np.ndarray:
    """The row that each byte position belongs to (empty rows own none)."""
    return np.searchsorted(off, positions, side="right") - 1


#: The white space of the word rules: blank and the controls 9 to 13.
SPACE_BYTES = np.zeros(256, bool)
SPACE_BYTES[[0x20, *range(0x09, 0x0E)]] = True


def word_spans(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+``; words never cross rows."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    word = ~SPACE_BYTES[data]
    first = word.copy()
    first[1:] &= ~word[:-1]
    last = word.copy()
    last[:-1] &= ~word[1:]
    edge = off[1:-1]
    edge = edge[(edge > 0) & (edge < len(data))]
    first[edge] = word[edge]
    last[edge - 1] = word[edge - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


_BASE = 0x9E3779B97F4A7C15
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2**64."""
    if len(_POWERS.get("p", ())) < n:
        size = 1 << max(16, (n - 1).bit_length())
        for key, base in (("p", _BASE), ("q", pow(_BASE, -1, 1 << 64))):
            x = np.full(size, base, U64)
            x[0] = 1
            _POWERS[key] = np.multiply.accumulate(x)
    return _POWERS["p"][:n], _POWERS["q"][:n]


#: A fixed random 64-bit value for each byte.
BYTE_VALUES = mix64(np.arange(1, 257, dtype=U64) * U64(0xD1342543DE82EF95))


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Sums of values[i] * base**i modulo 2**64, with a leading zero."""
    p, _ = _powers(len(values) + 1)
    out = np.zeros(len(values) + 1, U64)
    np.cumsum(values * p[:-1], out=out[1:])
    return out


def span_hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Position-free 64-bit hashes of the spans [start, end)."""
    _, q = _powers(len(sums))
    h = (sums[end] - sums[start]) * q[start]
    return mix64(h + (end - start).astype(U64) * U64(0xA0761D6478BD642F))


def spanning_forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, least node of its component) for the nodes of the edges a-b that are not the least themselves."""
    names, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    a, b = at[:len(a)], at[len(a):]
    label = np.arange(len(names))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        for x in (a, b, label[a], label[b]):
            np.minimum.at(new, x, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    at = np.flatnonzero(label != np.arange(len(names)))
    return names[at], names[label[at]]


#: Edges that one forest takes together.
FOREST_EDGES = 200_000


def _forests(e: DataFrame) -> DataFrame:
    """Edges (a, b) of the forests of blocks of edges: the same components with fewer edges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []
        held = 0
        for x in batches:
            kept.append(x)
            held += x.num_rows
            if held >= FOREST_EDGES:
                yield forest(kept)
                kept, held = [], 0
        if held:
            yield forest(kept)

    def forest(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(parts).combine_chunks()
        got = spanning_forest(*(c.to_numpy() for c in t.columns))
        return pa.RecordBatch.from_arrays([pa.array(c, t.schema.field(0).type) for c in got], names=t.column_names)

    return e.mapInArrow(run, e.schema)


def _all_stars(e: DataFrame) -> bool:
    """Whether every node either has one lower neighbour and no higher one, or higher ones only."""
    none = F.lit(None).cast(e.schema["b"].dataType)
    ends = e.select(F.col("a").alias("n"), F.col("b").alias("r")).unionAll(e.select(F.col("b").alias("n"), none.alias("r")))
    odd = ends.groupBy("n").agg(F.min("r").alias("lo"), F.max("r").alias("hi"), F.count_if(F.col("r").isNull()).alias("up"))
    return not odd.where("lo <> hi or (up > 0 and lo is not null)").limit(1).count()


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Map every node of ``edges`` to the smallest node that it can reach.

    Blocks of edges become spanning forests first. Then large-star and small-star
    steps alternate until all edges form stars around least nodes; each step is a
    minimum per node (aggregated before it is shuffled) and a join. Every round is
    written to the shared folder, so lost executors cost one round at most.
    Returns (node, component).
    """
    e = (edges.select(F.greatest(src, dst).alias("a"), F.least(src, dst).alias("b")).where("a <> b"))
    e = materialize(_forests(e).distinct(), "cc")
    while not _all_stars(e):
        # large star: neighbours above a node point to the node's least neighbour
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.join(low, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
                 .where("a <> b").distinct())
        # small star: a node and its lower neighbours point to the least of them
        low2 = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low2, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .where("a <> b")
                 .unionByName(low2.select("a", F.col("m").alias("b"))).distinct())
        e = materialize(small, "cc")
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


class WordStore:
    """Ids of words in growing flat arrays; expands a sequence of word numbers to their ids."""

    def __init__(self) -> None:
        self.known: dict[str, int] = {}
        self.flat = np.zeros(1 << 16, np.int32)
        self.start = np.zeros(1 << 14, np.int64)
        self.size = np.zeros(1 << 14, np.int64)
        self.rows = self.used = 0

    def add(self, ids: np.ndarray, counts: np.ndarray) -> int:
        """Append the id lists (flat, with their lengths); returns the number of the first."""
        first, n, k = self.rows, len(counts), len(ids)
        while self.rows + n > len(self.start):
            self.start = np.concatenate((self.start, np.zeros_like(self.start)))
            self.size = np.concatenate((self.size, np.zeros_like(self.size)))
        while self.used + k > len(self.flat):
            self.flat = np.concatenate((self.flat, np.zeros_like(self.flat)))
        self.flat[self.used:self.used + k] = ids
        self.size[first:first + n] = counts
        self.start[first:first + n] = self.used + np.cumsum(counts) - counts
        self.rows += n
        self.used += k
        return first

    def learn(self, words: list[str], ids: np.ndarray, counts: np.ndarray) -> None:
        first = self.add(ids, counts)
        self.known.update(zip(words, range(first, first + len(words))))

    def ids_of(self, number: int) -> np.ndarray:
        return self.flat[self.start[number]:self.start[number] + self.size[number]]

    def expand(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(flat ids, ids per number) of a sequence of word numbers."""
        n = self.size[numbers]
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(ends) else 0
        take = np.arange(total) + np.repeat(self.start[numbers] - (ends - n), n)
        return self.flat[take], n


def sums_by_row(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of ``values`` whose lengths are ``counts``."""
    total = np.concatenate(([0], np.cumsum(values)))
    at = np.concatenate(([0], np.cumsum(counts)))
    return total[at[1:]] - total[at[:-1]]
