"""Near-duplicate documents by SuperMinHash, banding, verification and connected components.

A document's set holds the hashes of its distinct word shingles (A-Z lower-cased,
words split at blanks and control characters). SuperMinHash gives each element a
random permutation of the signature's slots, drawn step by step: in step j it
offers j plus a random fraction to one slot it has not met. The least offer of a
slot wins, so once every slot has an offer from a step, later steps change
nothing and stop early. Offers of one element are correlated, which lowers the
variance of small sets' estimates. Signatures are cut into bands; documents that
agree in a band are candidates.

Documents with equal sets are one class. Within a band's bucket each class is
compared with the bucket's leader, the class that meets the most others. Where a
bucket then still holds several components, its members' hashed sets go to tiles
of bounded size (two chunks of the bucket each; buckets of the same members are one;
chunks of the largest component meet only chunks of the others),
a tile counts the shingles that its members share for all of them together, and
returns a spanning forest of the links across components, never the pairs. All links
are confirmed on the full sets of the whole texts. Components are found by joins.

Edge cases. Null texts and texts without words have an empty set and link with
nothing, nor do null ids (their component is null, they are kept). A text with
fewer words than a shingle has its whole word sequence as its one shingle. Rows
of equal ids are one node, also with different texts: a link of one is a link of
all. Texts of any length are read whole. Empty tables give empty results; other columns do not take part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qalake.llm.common import (BYTE_VALUES, TEXT_ROWS, U64, connected_components, gathered, materialize, mix64, prefix_sums,
                               slices, spanning_forest, span_hashes, utf8_bytes, word_spans)

#: Bands and rows of a band: of pairs at similarity 0.8 one in 20 million shares no band.
BANDS, ROWS = 32, 4
#: Members of a bucket's chunk, and shingles of their sets, about; shingles that a tile counts together.
CHUNK, CHUNK_SHINGLES, COUNTED = 512, 1 << 20, 4096
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def shingle_sets(texts: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets): the distinct shingle hashes of each text, in order of the hash."""
    data, off = utf8_bytes(texts)
    n = len(off) - 1
    start, end = word_spans(data, off)
    h = span_hashes(prefix_sums(BYTE_VALUES[_LOWER[data]]), start, end)
    row = np.searchsorted(off, start, side="right") - 1
    count = np.bincount(row, minlength=n)
    first = np.cumsum(count) - count
    # shingles of full length start at every word with words - 1 others of its text behind it
    place = np.arange(len(h)) - first[row]
    at = np.flatnonzero(place + words <= count[row])
    full = np.full(len(at), words, U64)
    for k in range(words):
        full = mix64(full * U64(0x9E3779B97F4A7C15) + h[at + k])
    rows, hashes = [row[at]], [full]
    short = np.flatnonzero((count > 0) & (count < words))
    for k in range(1, words):
        own = short[count[short] == k]
        x = np.full(len(own), k, U64)
        for j in range(k):
            x = mix64(x * U64(0x9E3779B97F4A7C15) + h[first[own] + j])
        rows.append(own)
        hashes.append(x)
    rows, hashes = np.concatenate(rows), np.concatenate(hashes)
    order = np.lexsort((hashes, rows))
    rows, hashes = rows[order], hashes[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
    rows, hashes = rows[new], hashes[new]
    return hashes, np.concatenate(([0], np.cumsum(np.bincount(rows, minlength=n))))


def super_min_hash(hashes: np.ndarray, off: np.ndarray, slots: int) -> np.ndarray:
    """Signatures (rows x slots) of sets; slots of empty sets hold the greatest integer."""
    n, none = len(off) - 1, np.iinfo(np.int64).max
    best = np.full(n * slots, none)
    row = np.repeat(np.arange(n), np.diff(off))
    perm: np.ndarray | None = None
    for step in range(slots):
        draw = mix64(hashes + U64((step + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
        pick = step + ((draw & U64(0xFFFF)) % U64(slots - step)).astype(np.int64)
        if step == 0:
            slot = pick
        else:
            at = np.arange(len(row))
            slot = perm[at, pick].astype(np.int64)
            perm[at, pick] = perm[:, step]
        offer = (step << 47) | (draw >> U64(17)).astype(np.int64)
        np.minimum.at(best, row * slots + slot, offer)
        open_rows = (best.reshape(n, slots) == none).any(1)
        go = open_rows[row]
        if not go.any():
            break
        if step == 0:
            first = pick[go]
            perm = np.tile(np.arange(slots, dtype=np.uint16), (len(first), 1))
            at = np.arange(len(first))
            perm[at, first] = 0
        elif not go.all():
            perm = perm[go]
        row, hashes = row[go], hashes[go]
    return best.reshape(n, slots)


def band_keys(signatures: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One 64-bit key per band (the band's number is part of it)."""
    s = signatures.astype(U64).reshape(len(signatures), bands, -1)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=U64), s.shape[:2]).copy()
    for k in range(s.shape[2]):
        key = mix64(key.ravel() * U64(0xD1342543DE82EF95) + s[:, :, k].ravel()).reshape(key.shape)
    return key.view(np.int64)


def signatures(docs: DataFrame, words: int, doc_id: str = "doc_id", text: str = "text",
               bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Rows (doc_id, n_shingles, s1, s2, bands): set size, 128 bits that name the set, band keys."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in gathered(batches, "text"):
            h, off = shingle_sets(b.column(1), words)
            n = np.diff(off)
            names = []
            for seed in (0x5851F42D4C957F2D, 0x14057B7EF767814F):  # sums of two mixed copies of the elements
                total = np.concatenate((np.zeros(1, U64), np.cumsum(mix64(h ^ U64(seed)))))
                names.append((total[off[1:]] - total[off[:-1]]).view(np.int64))
            keys = band_keys(super_min_hash(h, off, bands * rows), bands)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, bands, dtype=np.int32)),
                                             pa.array(keys.ravel()))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n), *map(pa.array, names), lists],
                                             ["doc_id", "n_shingles", "s1", "s2", "bands"])

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, f"doc_id {kind}, n_shingles long, s1 long, s2 long, bands array<long>")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of document ids whose full sets (cid, set) reach the similarity."""
    kind = sets.schema["cid"].dataType.simpleString()
    with_a = pairs.join(sets.select(F.col("cid").alias("a"), F.col("set").alias("set_a")), "a")
    both = with_a.join(sets.select(F.col("cid").alias("b"), F.col("set").alias("set_b")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(gathered(batches, "set_a"), "set_b"):
            (da, oa), (db, ob) = (utf8_bytes(b.column(i)) for i in (2, 3))
            na, nb = np.diff(oa) // 8, np.diff(ob) // 8
            row = np.concatenate((np.repeat(np.arange(len(na)), na), np.repeat(np.arange(len(nb)), nb)))
            h = np.frombuffer(np.concatenate((da, db)), U64)
            order = np.lexsort((h, row))
            row, h = row[order], h[order]
            same = np.bincount(row[1:][(row[1:] == row[:-1]) & (h[1:] == h[:-1])], minlength=len(na))
            keep = (100 * same >= percent * (na + nb - same)) & (na > 0)
            yield b.select([0, 1]).filter(pa.array(keep))

    return both.select("a", "b", "set_a", "set_b").mapInArrow(run, f"a {kind}, b {kind}")


def _sets(docs: DataFrame, members: DataFrame, words: int) -> DataFrame:
    """Rows (cid, set): the shingle hashes of the members' texts, in order."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.join(members.select(F.col("cid").alias("doc_id")).distinct(), "doc_id", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in gathered(batches, "text"):
            h, off = shingle_sets(b.column(1), words)
            data = np.ascontiguousarray(h).view(np.uint8)
            blobs = pa.Array.from_buffers(pa.large_binary(), b.num_rows, [None, pa.py_buffer(8 * off), pa.py_buffer(data)])
            yield pa.RecordBatch.from_arrays([b.column(0), blobs.cast(pa.binary())], ["cid", "set"])

    return texts.mapInArrow(run, f"cid {kind}, set binary")


def _mixed(rows: DataFrame) -> DataFrame:
    """Rows (key, cid, part, main, own, others) of the buckets that hold several components; buckets of the same members once.

    ``main`` says that the member is of its bucket's largest component; ``own`` and ``others`` count the chunks
    of the members that are (not) of it.
    """
    name = lambda seed: F.bit_xor(F.xxhash64(F.lit(seed), "cid"))
    keys = (rows.groupBy("key").agg(F.min("part").alias("low"), F.max("part").alias("high"), F.count("*").alias("size"),
                                    F.sum("n").alias("shingles"), name(1).alias("x1"), name(2).alias("x2"))
            .where("low <> high").groupBy("size", "shingles", "x1", "x2").agg(F.min("key").alias("key")))
    rows = rows.select("key", "cid", "part", "n").join(keys.select("key", "size", "shingles"), "key")
    parts = rows.groupBy("key", "size", "shingles", "part").agg(F.count("*").alias("of"), F.sum("n").alias("held"))
    largest = parts.groupBy("key", "size", "shingles").agg(F.max(F.struct("of", "part", "held")).alias("m"))
    chunks = lambda size, shingles: F.ceil(F.greatest(size / CHUNK, shingles / CHUNK_SHINGLES)).cast("int")
    largest = largest.select("key", F.col("m.part").alias("most"), chunks(F.col("m.of"), F.col("m.held")).alias("own"),
                             chunks(F.col("size") - F.col("m.of"), F.col("shingles") - F.col("m.held")).alias("others"))
    return rows.join(largest, "key").select("key", "cid", "part", (F.col("part") == F.col("most")).alias("main"), "own", "others")


def _tiles(rows: DataFrame) -> DataFrame:
    """Each member once for every tile (key, i, j) that its chunk is part of.

    The chunks of the largest component, numbered after the others, meet only those: two of its members need no link.
    """
    h = F.xxhash64(F.lit(3), "cid")
    chunk = F.when(F.col("main"), F.col("others") + F.pmod(h, F.col("own"))).otherwise(F.pmod(h, F.col("others"))).cast("int")
    last = F.when(F.col("main"), F.col("others")).otherwise(F.col("others") + F.col("own")) - 1
    rows = rows.withColumn("chunk", chunk)
    other = rows.select("key", "cid", "part", "chunk", F.explode(F.sequence(F.lit(0), last)).alias("other"))
    return other.select("key", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"), "chunk", "cid", "part")


def shared_counts(rows: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """How many hashes each two of ``n`` sets share, from (row, hash) pairs that occur once."""
    order = np.argsort(hashes, kind="stable")
    rows, hashes = rows[order], hashes[order]
    new = np.ones(len(hashes), bool)
    new[1:] = hashes[1:] != hashes[:-1]
    name = np.cumsum(new) - 1
    often = np.bincount(name)[name] > 1  # a hash of one set is shared by none
    rows, name = rows[often], name[often]
    name = np.cumsum(np.diff(name, prepend=name[:1]) != 0) if len(name) else name
    out = np.zeros((n, n), np.float64 if len(hashes) >> 24 else np.float32)
    for low in range(0, int(name[-1]) + 1 if len(name) else 0, COUNTED):
        a, b = np.searchsorted(name, (low, low + COUNTED))
        has = np.zeros((n, min(COUNTED, int(name[-1]) + 1 - low)), out.dtype)
        has[rows[a:b], name[a:b] - low] = 1
        out += has @ has.T
    return out


def _tile_links(tiles: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) across the components of each tile, as spanning forests; counted on the members' full sets."""
    kind = tiles.schema["cid"].dataType.simpleString()

    def forest(t: pa.Table) -> pa.RecordBatch:
        cid = t.column("cid").to_numpy()
        part, chunk = t.column("part").to_numpy(), t.column("chunk").to_numpy()
        data, off = utf8_bytes(t.column("set"))
        hashes, size = np.frombuffer(np.ascontiguousarray(data), U64), np.diff(off) // 8
        same = shared_counts(np.repeat(np.arange(len(cid)), size), hashes, len(cid))
        link = 100 * same >= percent * (size[:, None] + size[None, :] - same)
        link &= part[:, None] != part[None, :]
        i, j = t.column("i")[0].as_py(), t.column("j")[0].as_py()
        if i != j:
            link &= chunk[:, None] != chunk[None, :]
        a, b = np.nonzero(np.triu(link, 1))
        src, dst = spanning_forest(cid[a], cid[b])
        return pa.RecordBatch.from_arrays([pa.array(src, t.schema.field("cid").type), pa.array(dst, t.schema.field("cid").type)], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []  # rows of the last tile so far
        last = None
        for b in batches:
            names = np.stack([b.column(i).to_numpy() for i in range(3)], 1)
            cut = np.flatnonzero((names[1:] != names[:-1]).any(1)) + 1
            for at, end in zip([0, *cut.tolist()], [*cut.tolist(), len(names)]):
                if kept and tuple(names[at]) != last:
                    yield forest(pa.Table.from_batches(kept))
                    kept = []
                last = tuple(names[at])
                kept.append(b.slice(at, end - at))
        if kept:
            yield forest(pa.Table.from_batches(kept))

    by = ["key", "i", "j"]
    return (tiles.select(*by, "chunk", "cid", "part", "set").repartition(*by).sortWithinPartitions(*by)
            .mapInArrow(run, f"a {kind}, b {kind}").where("a <> b"))


def _same_id(usable: DataFrame, classes: DataFrame) -> DataFrame:
    """Edges (a, b) between the classes of an id that stands on different texts."""
    several = (usable.groupBy("doc_id").agg(F.min(F.struct("n_shingles", "s1", "s2")).alias("low"),
                                            F.max(F.struct("n_shingles", "s1", "s2")).alias("high"))
               .where("low <> high").select("doc_id"))
    own = usable.join(several, "doc_id").select("doc_id", "n_shingles", "s1", "s2").distinct()
    own = own.join(classes.select("n_shingles", "s1", "s2", "cid"), ["n_shingles", "s1", "s2"])
    return own.where("cid <> doc_id").select(F.col("cid").alias("a"), F.col("doc_id").alias("b"))


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, doc_id: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (least id reachable by links), kept."""
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    sig = materialize(signatures(docs, words), "minhash-signatures", TEXT_ROWS)
    usable = sig.where("n_shingles > 0 and doc_id is not null")
    classes = usable.groupBy("n_shingles", "s1", "s2").agg(F.min("doc_id").alias("cid"), F.first("bands").alias("bands"))
    classes = materialize(classes, "minhash-classes")
    members = classes.select("cid", F.col("n_shingles").alias("n"), F.explode("bands").alias("key"))
    sizes = members.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    shared = materialize(members.join(sizes, "key"), "minhash-buckets")

    # a bucket's leader is its member that meets the most others over all buckets: the text that copies vary
    weights = shared.groupBy("cid").agg(F.sum("size").alias("weight"))
    placed = shared.join(weights, "cid")
    leaders = placed.groupBy("key").agg(F.min_by(F.struct("cid", "n"), F.struct(-F.col("weight"), F.col("cid"))).alias("leader"))
    pairs = (shared.join(leaders, "key").where("cid <> leader.cid")
             .where(f"100 * least(n, leader.n) >= {percent} * greatest(n, leader.n)")
             .select(F.least("leader.cid", "cid").alias("a"), F.greatest("leader.cid", "cid").alias("b")).distinct())
    sets = materialize(_sets(docs, shared, words), "minhash-sets", TEXT_ROWS)  # the only time that texts are shuffled
    links = confirmed(pairs, sets, percent).unionByName(_same_id(usable, classes))
    links = materialize(links, "minhash-links", TEXT_ROWS)
    parts = connected_components(links, "a", "b").withColumnRenamed("node", "cid")

    # links across the components of a bucket
    placed = shared.join(parts, "cid", "left").withColumn("part", F.coalesce("component", "cid")).drop("component")
    rest = materialize(_mixed(placed), "minhash-mixed")
    more = materialize(_tile_links(_tiles(rest).join(sets, "cid"), percent), "minhash-links", TEXT_ROWS)
    if more.limit(1).count():
        parts = connected_components(links.unionByName(more), "a", "b").withColumnRenamed("node", "cid")

    named = classes.join(parts, "cid", "left").select(
        "n_shingles", "s1", "s2", F.coalesce("component", "cid").alias("component_id"))
    linked = usable.join(named, ["n_shingles", "s1", "s2"]).select("doc_id", "n_shingles", "component_id")
    alone = sig.where("n_shingles = 0 or doc_id is null").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone).select(
        "*", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, words: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without those that a smaller id of their component stands for; all columns stay."""
    gone = near_duplicates(docs, words, percent, doc_id, text).where("not kept").select(
        F.col("doc_id").alias("__gone_id")).distinct()
    return docs.join(gone, docs[doc_id] == F.col("__gone_id"), "left_anti")
