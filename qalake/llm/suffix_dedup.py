"""Suffix-array deduplication: removes bytes covered by a long string that also starts earlier.

A byte goes if a string of ``LENGTH`` bytes that covers it starts earlier too: in
a document with a smaller id, or earlier in its own. The suffixes that may share
``LENGTH`` bytes are found, then sorted one bucket at a time:

1. Buckets. Of the k-grams within a window of LENGTH bytes the one of least hash
   is the window's anchor (leftmost if equal), so equal windows have equal anchors
   at equal offsets. The suffixes whose windows have the same anchor text form a
   bucket; neighbouring windows of one anchor travel as one context. Buckets with
   one member drop out. Contexts that are equal as a whole (by 64 bits beside the
   anchor's 64) need no sorting: all but the first go.
2. Blockwise sort. The first of each of a bucket's different contexts is fetched
   from its text. A bucket's suffixes are aligned on the anchor, so those that can
   tie stand at equal offsets, and a cover sample of every ``PERIOD``-th column has
   a sampled column within reach of each at the same distance: the difference cover
   of the one difference that occurs, 0. Ranks of the sampled columns are computed
   first, from right to left, each from PERIOD symbols and the next rank. Then one
   offset at a time, suffixes are sorted by the few symbols before their next
   sampled column and that column's rank, which settles ties of any length without
   comparing them. Neighbours in that order that agree in LENGTH bytes are equal
   windows; all but the first in document order go.
3. A bucket of more contexts than its share of a task is split further by its
   windows' full hashes (128 bits), which bounds every block.

Repeats within a batch are settled where they are read, so a passage in any
number of documents sends one row per batch at most. Each document's removed
spans are unions of windows, applied to its bytes at the end.

Edge cases. Texts are their UTF-8 bytes; null texts are empty, and texts under
LENGTH bytes lose nothing. Ids are whole numbers; null ids come before all
others. Rows equal in id and text count as one document and get equal results;
rows of equal ids and different texts follow each other by the text's hash.
Texts of any length are read whole; empty tables give empty results; other
columns do not take part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from qalake.llm.common import (BYTE_VALUES, TEXT_ROWS, U64, gathered, materialize, mix64, prefix_sums, shuffle_partitions,
                               span_hashes, utf8_bytes)

#: Bytes of a string that counts, and of an anchor.
LENGTH, GRAM = 100, 24
#: Most offsets of an anchor in its window; columns of a cover period (9-bit symbols of a 64-bit key).
REACH, PERIOD = LENGTH - GRAM, 7
_WIDTH = REACH + LENGTH
_NULL_ID = -(1 << 63)


def anchors(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, ...]:
    """(row, low, shift, more, anchor hash, context hash) of the contexts of a batch of texts.

    A context's windows start at low .. low + more (positions in ``data``); its anchor is at low + shift.
    """
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < LENGTH:
        return none, none, none, none, none, none
    sums = prefix_sums(BYTE_VALUES[data])
    at = np.arange(n - GRAM + 1)
    gram = span_hashes(sums, at, at + GRAM)
    # the least hash of a window and its place in one integer: the leftmost of equal hashes is the least
    low = gram >> U64(31) << U64(31) | at.astype(U64)
    step = 1
    while 2 * step <= REACH + 1:
        low = np.minimum(low[:-step], low[step:])
        step *= 2
    rest = REACH + 1 - step
    low = np.minimum(low[:len(low) - rest], low[rest:]) if rest else low
    size = np.maximum(np.diff(off) - LENGTH + 1, 0)  # windows of each text
    row = np.repeat(np.arange(len(size)), size)
    start = np.arange(len(row)) + np.repeat(off[:-1] - (np.cumsum(size) - size), size)
    where = (low[start] & U64((1 << 31) - 1)).astype(np.int64)
    new = np.ones(len(row), bool)
    new[1:] = (where[1:] != where[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(row)) - 1 if len(first) else first
    lo, hi, anchor = start[first], start[last], where[first]
    context = mix64(span_hashes(sums, lo, hi + LENGTH) + (anchor - lo).astype(U64))
    return row[first], lo, anchor - lo, hi - lo, gram[anchor].view(np.int64), context.view(np.int64)


def _firsts(keys: list[np.ndarray], order_by: list[np.ndarray]) -> np.ndarray:
    """Whether a row is the first, in the order of ``order_by``, of those with its keys."""
    order = np.lexsort((*reversed(order_by), *reversed(keys)))
    new = np.ones(len(order), bool)
    for k in keys:
        new[1:] &= k[order[1:]] == k[order[:-1]]
    out = np.ones(len(order), bool)
    out[order[1:]] = ~new[1:]
    return out


def _find_anchors(docs: DataFrame) -> DataFrame:
    """Rows (a, x, doc, fp, place): anchor and context hash of every context.

    place is low << 14 | shift << 7 | more. Contexts with an equal, earlier one in
    their batch have a negative place, and a key that spreads them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in gathered(batches, "text"):
            data, off = utf8_bytes(b.column(2))
            row, lo, shift, more, a, x = anchors(data, off)
            doc, fp = (b.column(i).to_numpy()[row] for i in (0, 1))
            place = (lo - off[row]) << 14 | shift << 7 | more
            first = _firsts([a, x], [doc, fp, place])
            a = np.where(first, a, mix64(doc.astype(U64) * U64(0x9E3779B97F4A7C15) + place.astype(U64)).view(np.int64))
            place = np.where(first, place, -1 - place)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (a, x, doc, fp, place)], ["a", "x", "doc", "fp", "place"])

    return docs.mapInArrow(run, "a long, x long, doc long, fp long, place long")


def _settle(rows: DataFrame) -> DataFrame:
    """Rows (a, doc, fp, place, open): contexts that go whole (open false), and firsts of buckets with several.

    Reads sorted rows as a stream; between batches it keeps the last bucket's first row.
    """
    names = ["a", "x", "doc", "fp", "place"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_a = last_x = pending = None  # pending: the only first so far of the last bucket, not yet sent

        def out(cols: list[np.ndarray], opened: bool) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [*(pa.array(cols[i]) for i in (0, 2, 3, 4)), pa.array(np.full(len(cols[0]), opened))],
                ["a", "doc", "fp", "place", "open"])

        for b in batches:
            cols = [b.column(n).to_numpy() for n in names]
            done = cols[4] < 0
            if done.any():
                gone = [c[done] for c in cols]
                gone[4] = -1 - gone[4]
                yield out(gone, False)
                cols = [c[~done] for c in cols]
            a, x = cols[0], cols[1]
            if not len(a):
                continue
            new_a, new_x = np.ones(len(a), bool), np.ones(len(a), bool)
            new_a[1:] = a[1:] != a[:-1]
            new_x[1:] = new_a[1:] | (x[1:] != x[:-1])
            new_a[0] = last_a is None or a[0] != last_a
            new_x[0] = new_a[0] or x[0] != last_x
            yield out([c[~new_x] for c in cols], False)
            run_of = np.cumsum(new_a)
            firsts = np.flatnonzero(new_x)
            count = np.bincount(run_of[firsts], minlength=int(run_of[-1]) + 1)
            several = count[run_of[firsts]] > 1
            several |= run_of[firsts] == 0  # another context of the bucket that the last batch ended in
            if count[0] and pending is not None:
                yield out(pending, True)
                pending = None
            yield out([c[firsts[several]] for c in cols], True)
            if run_of[-1] > 0:  # a new last bucket
                own = firsts[run_of[firsts] == run_of[-1]]
                pending = [c[own] for c in cols] if len(own) == 1 else None
            last_a, last_x = a[-1], x[-1]

    return rows.mapInArrow(run, "a long, doc long, fp long, place long, open boolean")


def _fetch(open_rows: DataFrame, docs: DataFrame, most: int) -> DataFrame:
    """Contexts with their bytes, or, of buckets above ``most``, their windows' hashes.

    Rows (kind, a, b, doc, fp, place, bytes): kind 0 goes (a span: place its start, b its end),
    1 is a context, 2 a window (a and b its hashes, place its start).
    """
    big = open_rows.groupBy("a").count().where(F.col("count") > most).select(F.col("a").alias("_a"))
    marked = open_rows.join(big, F.col("a") == F.col("_a"), "left").withColumn("split", F.col("_a").isNotNull())
    lists = marked.groupBy("doc", "fp").agg(F.collect_list(F.struct("a", "place", "split")).alias("items"))
    both = lists.join(docs, ["doc", "fp"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in gathered(batches, "text"):
            data, off = utf8_bytes(b.column(2))
            items = b.column(3)
            n = items.value_lengths().to_numpy()
            flat = items.flatten()
            a, place, split = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(3))
            row = np.repeat(np.arange(b.num_rows), n)
            doc, fp = b.column(0).to_numpy()[row], b.column(1).to_numpy()[row]
            low, more = place >> 14, place & 127
            start = off[row] + low
            plain = np.flatnonzero(~split)
            size = more[plain] + LENGTH
            ends = np.cumsum(size)
            take = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(start[plain] - (ends - size), size)
            text = pa.BinaryArray.from_buffers(
                pa.binary(), len(plain), [None, pa.py_buffer(np.concatenate(([0], ends)).astype(np.int32)),
                                          pa.py_buffer(np.ascontiguousarray(data[take]))])
            if len(plain):
                yield _parts(1, a[plain], np.zeros(len(plain), np.int64), doc[plain], fp[plain], place[plain], text)
            cut = np.flatnonzero(split)
            if len(cut):
                sums = prefix_sums(BYTE_VALUES[data])
                k = more[cut] + 1
                own = np.repeat(cut, k)
                step = np.arange(len(own)) - np.repeat(np.cumsum(k) - k, k)
                s = start[own] + step
                h = span_hashes(sums, s, s + LENGTH).view(np.int64)
                # a second hash: the sums of the bytes mixed with another seed
                other = prefix_sums(mix64(BYTE_VALUES[data] + U64(1)))
                g = (span_hashes(other, s, s + LENGTH) ^ a[own].view(U64)).view(np.int64)
                begin = low[own] + step
                first = _firsts([h, g], [doc[own], fp[own], begin])
                yield _parts(2, h[first], g[first], doc[own][first], fp[own][first], begin[first])
                gone = ~first
                yield _parts(0, h[gone], begin[gone] + LENGTH, doc[own][gone], fp[own][gone], begin[gone])

    return both.select("doc", "fp", "text", "items").mapInArrow(
        run, "kind int, a long, b long, doc long, fp long, place long, bytes binary")


def _parts(kind: int, a, b, doc, fp, place, text: pa.Array | None = None) -> pa.RecordBatch:
    n = len(a)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(n, kind, np.int32)), *(pa.array(c) for c in (a, b, doc, fp, place)),
         pa.nulls(n, pa.binary()) if text is None else text],
        ["kind", "a", "b", "doc", "fp", "place", "bytes"])


def sort_block(bucket: np.ndarray, order_key: list[np.ndarray], shift: np.ndarray, more: np.ndarray,
               data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows with an earlier equal one in their bucket: (context, least step, greatest step).

    Contexts are given by bucket number, order (doc, fp, low), offset of the anchor
    in the first window, number of further windows, and their bytes.
    """
    order = np.lexsort(tuple(reversed(order_key)))
    bucket, shift, more = bucket[order], shift[order], more[order]
    n, size = len(order), np.diff(off)[order]
    # symbols: 0 outside the context, else the byte plus 1; the anchor stands at column REACH
    grid = np.zeros((n, _WIDTH + PERIOD), np.uint16)
    row = np.repeat(np.arange(n), size)
    col = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
    grid[row, col + REACH - shift[row]] = data[np.repeat(off[:-1][order], size) + col].astype(np.uint16) + 1

    def head(c: int, k: int) -> np.ndarray:
        key = np.zeros(n, U64)
        for j in range(k):
            key = key << U64(9) | grid[:, c + j].astype(U64)
        return key

    def ranks(keys: list[np.ndarray]) -> np.ndarray:
        by = np.lexsort(tuple(reversed(keys)))
        new = np.zeros(n, np.int64)
        step = np.zeros(n, bool)
        for k in keys:
            step[1:] |= k[by[1:]] != k[by[:-1]]
        new[by] = np.cumsum(step)
        return new

    # the cover sample: ranks of every PERIOD-th column's suffixes, from right to left
    rank = {}
    behind = np.zeros(n, np.int64)
    for c in range((_WIDTH - 1) // PERIOD * PERIOD, -1, -PERIOD):
        behind = rank[c] = ranks([head(c, PERIOD), behind])
    least, most = np.full(n, LENGTH), np.full(n, -1)
    for d in range(REACH + 1):  # the anchor's offset in the window; its first column is REACH - d
        own = np.flatnonzero((shift >= d) & (shift - more <= d))
        if len(own) < 2:
            continue
        c = REACH - d
        sample = -(-c // PERIOD) * PERIOD
        tail = rank[sample] if sample in rank else np.zeros(n, np.int64)
        by = own[np.lexsort((own, tail[own], head(c, sample - c)[own], bucket[own]))]
        same = bucket[by[1:]] == bucket[by[:-1]]
        pairs = np.flatnonzero(same)
        same[pairs] = (grid[by[pairs + 1], c:c + LENGTH] == grid[by[pairs], c:c + LENGTH]).all(1)
        # the first in document order of each run of equal windows stays
        run = np.concatenate(([0], np.cumsum(~same)))
        first = np.full(run[-1] + 1, n)
        np.minimum.at(first, run, by)
        gone = by[by != first[run]]
        step = shift[gone] - d
        least[gone] = np.minimum(least[gone], step)
        most[gone] = np.maximum(most[gone], step)
    hit = np.flatnonzero(most >= 0)
    return order[hit], least[hit], most[hit]


#: Contexts that one sort takes together (whole buckets).
BLOCK = 8192


def _sort_buckets(contexts: DataFrame) -> DataFrame:
    """Spans (doc, fp, start, end) that go, from contexts sorted by bucket."""

    def spans(t: pa.Table) -> pa.RecordBatch:
        a, doc, fp, place = (t.column(n).to_numpy() for n in ("a", "doc", "fp", "place"))
        data, off = utf8_bytes(t.column("bytes"))
        low = place >> 14
        hit, least, most = sort_block(a, [doc, fp, low], place >> 7 & 127, place & 127, data, off)
        return pa.RecordBatch.from_arrays(
            [pa.array(doc[hit]), pa.array(fp[hit]), pa.array(low[hit] + least), pa.array(low[hit] + most + LENGTH)],
            ["doc", "fp", "start", "end"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []
        held = 0
        for b in batches:
            kept.append(b)
            held += b.num_rows
            if held < BLOCK:
                continue
            t = pa.Table.from_batches(kept).combine_chunks()
            a = t.column("a").to_numpy()
            whole = int(np.searchsorted(a, a[-1]))  # the last bucket may go on
            at = 0
            while at < whole:
                end = min(at + BLOCK, whole)
                end = whole if end == whole else max(int(np.searchsorted(a, a[end])), at)
                if end == at:  # a bucket larger than a block
                    end = int(np.searchsorted(a, a[at], side="right"))
                yield spans(t.slice(at, end - at).combine_chunks())
                at = end
            kept, held = t.slice(whole).to_batches(), t.num_rows - whole
        if held:
            yield spans(pa.Table.from_batches(kept).combine_chunks())

    return contexts.select("a", "doc", "fp", "place", "bytes").mapInArrow(
        run, "doc long, fp long, start long, end long")


def _document_rows(docs: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, bool]:
    """Rows (doc, fp, text) and whether ids repeat; fp tells rows of equal ids apart and is 0 where all differ."""
    ids = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(_NULL_ID)).alias("doc"), F.col(text).alias("text"))
    clash = bool(ids.groupBy("doc").count().where("count > 1").limit(1).count())
    fp = F.xxhash64(F.coalesce("text", F.lit(""))).bitwiseOR(F.lit(1)) if clash else F.lit(0).cast("long")
    return ids.select("doc", fp.alias("fp"), "text"), clash


def removed_spans(rows: DataFrame) -> DataFrame:
    """Spans (doc, fp, start, end) to remove from distinct rows (doc, fp, text); spans of a document may overlap."""
    parts = shuffle_partitions(rows.sparkSession)
    found = _find_anchors(rows).repartition(parts, "a").sortWithinPartitions("a", "x", "doc", "fp", "place")
    settled = materialize(_settle(found), "suffix-contexts")
    whole = settled.where("not open").select(
        "doc", "fp", F.shiftright("place", 14).alias("start"),
        (F.shiftright("place", 14) + F.col("place").bitwiseAND(127) + LENGTH).alias("end"))
    opened = settled.where("open").drop("open")
    n = opened.count()
    fetched = materialize(_fetch(opened, rows, max(64, n // (4 * parts))), "suffix-texts", TEXT_ROWS)
    sorted_spans = _sort_buckets(fetched.where("kind = 1").repartition(parts, "a").sortWithinPartitions("a"))
    order = Window.partitionBy("a", "b").orderBy("doc", "fp", "place")
    windows = (fetched.where("kind = 2").withColumn("_n", F.row_number().over(order)).where("_n > 1")
               .select("doc", "fp", F.col("place").alias("start"), (F.col("place") + LENGTH).alias("end")))
    settled_windows = fetched.where("kind = 0").select("doc", "fp", F.col("place").alias("start"), F.col("b").alias("end"))
    return whole.unionByName(sorted_spans).unionByName(windows).unionByName(settled_windows)


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", with_bytes: bool = False) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and the kept bytes)."""
    rows, clash = _document_rows(docs, doc_id, text)
    once = rows.dropDuplicates(["doc", "fp"]) if clash else rows
    spans = removed_spans(once).groupBy("doc", "fp").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    both = rows.join(spans, ["doc", "fp"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in gathered(batches, "text"):
            data, off = utf8_bytes(b.column(1))
            lists = b.column(2)
            n = np.asarray([x or 0 for x in lists.value_lengths().to_pylist()], np.int64)
            flat = lists.flatten()
            base = np.repeat(off[:-1], n)
            # +1 where a span starts and -1 where it ends: covered where the sum is above 0
            edge = np.zeros(len(data) + 1, np.int32)
            if len(flat):
                np.add.at(edge, base + flat.field(0).to_numpy(), 1)
                np.add.at(edge, base + flat.field(1).to_numpy(), -1)
            gone = np.cumsum(edge[:-1]) > 0
            opens = gone.copy()
            opens[1:] &= ~gone[:-1]
            inner = off[1:-1][off[1:-1] < len(data)]
            opens[inner] = gone[inner]
            total = np.concatenate(([0], np.cumsum(gone)))
            runs = np.concatenate(([0], np.cumsum(opens)))
            kept = data[~gone]
            left = off - total[off]
            view = memoryview(np.ascontiguousarray(kept))
            pieces = [view[i:j] for i, j in zip(left[:-1].tolist(), left[1:].tolist())]
            cols = [b.column(0), pa.array(np.diff(off)), pa.array(total[off[1:]] - total[off[:-1]]),
                    pa.array(runs[off[1:]] - runs[off[:-1]]),
                    pa.array([hashlib.sha256(p).hexdigest() for p in pieces], pa.string())]
            names = ["doc", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if with_bytes:
                cols.append(pa.array([bytes(p) for p in pieces], pa.binary()))
                names.append("kept")
            yield pa.RecordBatch.from_arrays(cols, names)

    out = both.select("doc", "text", "spans").mapInArrow(
        run, "doc long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_bytes)
    return out.select(F.nullif("doc", F.lit(_NULL_ID)).alias("doc_id"), *out.columns[1:])
