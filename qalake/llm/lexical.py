"""Ranked lexical search: all items at once, by shared sums of term scores.

Items (the stated queries) go in blocks of bounded size. Terms that items share are
mined once per block: terms of the same items form one sum, and then the pair of
sums that most items still have together becomes a new sum, until no pair occurs
twice. The result is a graph in which every sum has two parents' scores and
every item adds up a few sums.

The documents are read once per block, into written postings of the block's terms
(with the corpus counts that scores need), without any shuffle of postings: a
term that every document holds is a column like any other. A second pass takes the
documents in small groups, fills the terms' score columns, computes every shared
sum of the graph once, and adds the items' sums. Each task keeps the best of
each item only, so k rows per item and task meet in the final ranking.

Scores are 64-bit integers throughout. Terms are looked up by 64-bit hashes.

Edge cases. Null and empty texts have no terms: such documents count nowhere and
match nothing, such items return no rows. Every row is a document of its own, also
with equal or null ids; equal scores rank by id, null ids last. Rows of equal item
ids are items of their own. Empty tables give empty results; other columns do
not take part. Texts of any length are read whole.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from qalake.llm.common import (BYTE_VALUES, TEXT_ROWS, gathered, materialize, prefix_sums, span_hashes, utf8_bytes)

#: Items of a block, and characters of their texts, about.
BLOCK_ITEMS, BLOCK_CHARS = 512, 4 << 20
#: Sums of an item among which shared pairs are mined together (a longer item is mined in pieces).
PIECE = 256
#: Documents that are scored together.
SCORED = 256

_TERM = np.zeros(256, bool)
_TERM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def term_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, row of each): the terms of each text in order, with repeats."""
    data, off = utf8_bytes(texts)
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    data = _LOWER[data]
    term = _TERM[data]
    first, last = term.copy(), term.copy()
    first[1:] &= ~term[:-1]
    last[:-1] &= ~term[1:]
    edge = off[1:-1]
    edge = edge[(edge > 0) & (edge < len(data))]
    first[edge] = term[edge]
    last[edge - 1] = term[edge - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return span_hashes(prefix_sums(BYTE_VALUES[data]), start, end), np.searchsorted(off, start, side="right") - 1


class SharedSums:
    """The graph of sums that a block's items share. Sums below ``n_terms`` are the terms' own scores."""

    def __init__(self, items: list[list[int]], n_terms: int):
        self.n_terms = n_terms
        self.pairs: list[tuple[int, int]] = []
        holders: dict[int, list[int]] = defaultdict(list)
        for k, terms in enumerate(items):
            for t in terms:
                holders[t].append(k)
        alike: dict[tuple[int, ...], list[int]] = defaultdict(list)
        for t in sorted(holders):
            alike[tuple(holders[t])].append(t)
        self.items: list[list[int]] = [[] for _ in items]
        for which, terms in alike.items():
            if len(which) > 1:  # one sum for all terms of just these items
                total = terms[0]
                for t in terms[1:]:
                    total = self._add(total, t)
                terms = [total]
            for k in which:
                self.items[k] += terms
        self._mine()

    def _add(self, a: int, b: int) -> int:
        self.pairs.append((a, b))
        return self.n_terms + len(self.pairs) - 1

    def _mine(self) -> None:
        """Turn pairs of sums that several items have into sums of their own, the commonest first."""
        count = Counter(x for s in self.items for x in s)
        # sums of one item only can share nothing
        alone = [[x for x in s if count[x] == 1] for s in self.items]
        pieces: list[tuple[int, set[int]]] = []
        for k, s in enumerate(self.items):
            rest = sorted((x for x in s if count[x] > 1), key=lambda x: (-count[x], x))
            pieces += [(k, set(rest[i:i + PIECE])) for i in range(0, len(rest), PIECE)]
        where: dict[int, set[int]] = defaultdict(set)
        together: Counter[tuple[int, int]] = Counter()
        for p, (_, s) in enumerate(pieces):
            for x in s:
                where[x].add(p)
            together.update(combinations(sorted(s), 2))
        heap = [(-n, pair) for pair, n in together.items() if n > 1]
        heapq.heapify(heap)
        while heap:
            n, (a, b) = heapq.heappop(heap)
            now = together[a, b]
            if now != -n:  # counts only fall behind a pair's back
                if now > 1:
                    heapq.heappush(heap, (-now, (a, b)))
                continue
            new = self._add(a, b)
            grown: Counter[int] = Counter()
            for p in sorted(where[a] & where[b]):
                s = pieces[p][1]
                s -= {a, b}
                for x in s:
                    together[min(a, x), max(a, x)] -= 1
                    together[min(b, x), max(b, x)] -= 1
                grown.update(s)
                s.add(new)
                for x in (a, b):
                    where[x].discard(p)
                where[new].add(p)
            together[a, b] = 0
            for x, n in grown.items():
                together[x, new] = n
                if n > 1:
                    heapq.heappush(heap, (-n, (x, new)))
        self.items = alone
        for k, s in pieces:
            self.items[k] = self.items[k] + sorted(s)

    def additions(self) -> int:
        """Additions that one document's scores take."""
        return len(self.pairs) + sum(max(0, len(s) - 1) for s in self.items)

    def scores(self, sums: np.ndarray) -> np.ndarray:
        """Items x documents, from an array (all sums x documents) whose first ``n_terms`` rows are filled."""
        for k, (a, b) in enumerate(self.pairs):
            np.add(sums[a], sums[b], out=sums[self.n_terms + k])
        out = np.zeros((len(self.items), sums.shape[1]), np.int64)
        for k, s in enumerate(self.items):
            if s:
                np.add.reduce(sums[s], axis=0, out=out[k])
        return out


def _postings(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """Rows (doc_id, n, terms, tfs) of documents, and one row per task with its counts (docs, total, df)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    table = docs.sparkSession.sparkContext.broadcast(vocabulary)  # the terms of a block of items

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = table.value
        df, n_docs, total, id_type = np.zeros(len(known), np.int64), 0, 0, None
        names = ["doc_id", "n", "terms", "tfs", "docs", "total", "df"]
        for b in gathered(batches, "text"):
            id_type = b.column(0).type
            h, row = term_hashes(b.column(1))
            n = np.bincount(row, minlength=b.num_rows)
            n_docs += int((n > 0).sum())
            total += len(h)
            at = np.searchsorted(known, h)
            at[at == len(known)] = 0
            hit = known[at] == h
            pair, tf = np.unique(row[hit] * len(known) + at[hit], return_counts=True)
            doc, term = np.divmod(pair, len(known))
            df += np.bincount(term, minlength=len(known))
            some = np.flatnonzero(np.bincount(doc, minlength=b.num_rows))  # documents with a term of an item
            off = np.concatenate(([0], np.cumsum(np.bincount(doc, minlength=b.num_rows)[some])))
            blob = lambda x: pa.Array.from_buffers(pa.binary(), len(some), [
                None, pa.py_buffer((4 * off).astype(np.int32)), pa.py_buffer(x.astype(np.int32))])
            none = pa.nulls(len(some), pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(some)), pa.array(n[some]), blob(term), blob(tf),
                                              none, none, pa.nulls(len(some), pa.binary())], names)
        if id_type is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, id_type), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary()),
                 pa.array([n_docs]), pa.array([total]), pa.array([df.tobytes()], pa.binary())], names)

    return docs.mapInArrow(run, f"doc_id {kind}, n long, terms binary, tfs binary, docs long, total long, df binary")


def _corpus_counts(postings: DataFrame, n_terms: int) -> tuple[int, int, np.ndarray]:
    """(documents with a term, all terms, documents of each of the block's terms)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(n_terms, np.int64)
        for b in batches:
            for x in b.column(0).to_pylist():
                df += np.frombuffer(x, np.int64)
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(df[at])], ["term", "df"])

    counts = postings.where("df is not null")
    n, total = counts.agg(F.sum("docs"), F.sum("total")).first()
    df = np.zeros(n_terms, np.int64)
    got = counts.select("df").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toPandas()
    df[got["term"].to_numpy(np.int64)] = got["df"].to_numpy(np.int64)  # one row per term of the block
    return n or 0, total or 0, df


def _keep_best(best: pa.Table, k: int) -> pa.Table:
    """The k best documents of each item: highest score, then smallest id, null ids last."""
    best = best.sort_by([("item", "ascending"), ("score", "descending"), ("doc_id", "ascending")]).combine_chunks()
    item = best.column("item").to_numpy()
    first = np.searchsorted(item, item, side="left")
    return best.filter(pa.array(np.arange(len(item)) - first < k))


def _best(postings: DataFrame, graph: SharedSums, weight: np.ndarray, n_docs: int, total: int, k: int) -> DataFrame:
    """Rows (item, doc_id, score): the best k documents of each item in each task."""
    kind = postings.schema["doc_id"].dataType.simpleString()
    shared = postings.sparkSession.sparkContext.broadcast((graph, weight))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        graph, weight = shared.value
        sums = np.zeros((graph.n_terms + len(graph.pairs), SCORED), np.int64)
        floor = np.ones(len(graph.items), np.int64)  # the score that a document must reach
        best: pa.Table | None = None
        for whole in batches:
            for start in range(0, whole.num_rows, SCORED):
                b = whole.slice(start, SCORED)
                term, off = (np.frombuffer(np.ascontiguousarray(x), np.int32) if i == 0 else x // 4
                             for i, x in enumerate(utf8_bytes(b.column(2))))
                tf = np.frombuffer(np.ascontiguousarray(utf8_bytes(b.column(3))[0]), np.int32).astype(np.int64)
                doc = np.repeat(np.arange(b.num_rows), np.diff(off))
                m = 10 + 90 * b.column(1).to_numpy() * n_docs // total
                sums[:graph.n_terms] = 0
                sums[term, doc] = weight[term] * (1_000_000_000 * tf // (1000 * tf + 8 * m[doc]))
                scores = graph.scores(sums)[:, :b.num_rows]
                item, at = np.nonzero(scores >= floor[:, None])
                if not len(item):
                    continue
                new = pa.table({"item": item, "score": scores[item, at], "doc_id": b.column(0).take(pa.array(at))})
                best = _keep_best(new if best is None else pa.concat_tables([best, new]), k)
                held = best.column("item").to_numpy()
                full = np.flatnonzero(np.bincount(held, minlength=len(floor)) == k)
                floor[full] = best.column("score").to_numpy()[np.searchsorted(held, full, side="right") - 1]
        if best is not None:
            yield from best.select(["item", "doc_id", "score"]).to_batches()

    return postings.where("terms is not null").select("doc_id", "n", "terms", "tfs").mapInArrow(
        run, f"item long, doc_id {kind}, score long")


def _block(docs: DataFrame, texts: list[str], k: int) -> DataFrame | None:
    """Rows (item, doc_id, score): each item's k best documents of every task; None without terms."""
    h, row = term_hashes(pa.array(texts, pa.string()))
    vocabulary, at = np.unique(h, return_inverse=True)
    if not len(vocabulary):
        return None
    items: list[list[int]] = [[] for _ in texts]
    for r, t in sorted(set(zip(row.tolist(), at.tolist()))):
        items[r].append(t)
    postings = materialize(_postings(docs, vocabulary), "lexical-postings", TEXT_ROWS)
    n_docs, total, df = _corpus_counts(postings, len(vocabulary))
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)
    return _best(postings, SharedSums(items, len(vocabulary)), weight, n_docs, total, k)


def search(items: DataFrame, docs: DataFrame, k: int = 10, item_id: str = "item_id", doc_id: str = "doc_id",
           text: str = "text") -> DataFrame:
    """Rows (item_id, rank, doc_id, score): the k documents of the highest scores above 0 for each item."""
    spark = items.sparkSession
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    items = materialize(items.select(F.col(item_id).alias("item_id"), F.col(text).alias("text"),
                                     F.monotonically_increasing_id().alias("at")), "lexical-items")
    n, chars = items.agg(F.count("*"), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    blocks = max(-(-n // BLOCK_ITEMS), -(-chars // BLOCK_CHARS))
    found = None
    for block in range(blocks):
        own = items.where(F.pmod(F.xxhash64("at"), F.lit(blocks)) == block)
        texts = own.where("text is not null").select("at", "text").orderBy("at").collect()  # about BLOCK_ITEMS rows
        got = _block(docs, [r["text"] for r in texts], k)
        if got is None:
            continue
        names = spark.createDataFrame([(i, r["at"]) for i, r in enumerate(texts)], "item long, at long")
        got = got.join(F.broadcast(names), "item").select("at", "doc_id", "score")
        found = got if found is None else found.unionAll(got)
    kind, id_kind = (df.schema[c].dataType.simpleString() for df, c in ((items, "item_id"), (docs, "doc_id")))
    if found is None:
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id {id_kind}, score long")
    order = Window.partitionBy("at").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.join(items.select("at", "item_id"), "at").select("item_id", "rank", "doc_id", "score")
