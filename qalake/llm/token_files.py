"""Token-id output: frequency-ranked ids in byte-aligned variable-length code.

A tokenizer of the ``tokenizers`` library gives the ids; each document gets an
end id. Ids are ranked by their count in the whole corpus, so frequent ids take
one byte. The file format is a folder of Parquet files in ascending document
order, one row per document: ``control`` has two bits per id (its length in
bytes less one, four ids per byte, low bits first) and ``data`` the bytes of
the ranks (little endian). ``ranks`` beside it has the id of every rank.
Decoding looks lengths up by control byte and ids up by rank.

White space separates the tokenizer's pre-tokens and is dropped, so a text's
ids are those of its words in order. Words are encoded by the library once per
task and kept (a bounded number of them).

Edge cases. Null and empty texts have just the end id. Rows of equal document
ids keep one order in the files, null ids come first. Empty tables give empty
files. Other columns are not written.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from qalake.llm.common import TEXT_ROWS, WORD_SLICE_BYTES, WordStore, gathered, materialize, sums_by_row, utf8_bytes
from qalake.session import scratch_path

#: Words that one task keeps with their ids (a bound on its memory; the results do not depend on it).
KEPT_WORDS = 1_000_000
#: Words of letters that the library encodes as one line.
LINE_WORDS = 1000


class WordEncoder:
    """Ids of texts by a tokenizer whose pre-tokens end at white space."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.vocab = self.tok.get_vocab_size()
        probe = ["Ab cd", "ab\n cd", " ab  cd "]
        if len({tuple(self._library([p])[0]) for p in probe}) != 1:
            raise ValueError("only tokenizers that lower the case and drop white space are supported")
        marks = ["zé", ".", ",", "..", ",.", ".,,", "...", "ab", "ß"]
        ids = dict(zip(marks, self._library(marks)))
        for word in ("zé", "ab", "ß"):
            for tail in marks[1:7]:
                if self._library([word + tail])[0] != ids[word] + ids[tail]:
                    raise ValueError("only tokenizers that cut words before full stops and commas are supported")
        self.store = WordStore()
        mark = json.loads(self.tok.to_str())["model"].get("end_of_word_suffix")
        self.ends = np.zeros(self.vocab, bool)  # ids that end a pre-token, where the model marks them
        if mark:
            self.ends[[i for t, i in self.tok.get_vocab().items() if t.endswith(mark) and i < self.vocab]] = True

        self.model = self.tok.model
        probe = ["a", "the", "running", "zzzyx", "qwertyuiopasdfgh", "e" * 40, *(chr(97 + i) + chr(122 - i) for i in range(26))]
        self.direct = bool(mark) and all((a == b).all() for a, b in zip(self._plain(probe), self._each(probe)))

    def _library(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _numbers(self, words: pa.Array) -> np.ndarray:
        """Store numbers of words, encoding the new ones."""
        known = self.store.known
        words = words.to_pylist()
        numbers = np.array([known.get(w, -1) for w in words], np.int64)
        at = np.flatnonzero(numbers < 0)
        new = [words[i] for i in at.tolist()]
        kinds: dict[bool | None, list[str]] = {True: [], False: [], None: []}
        for w in new:
            kinds[w.isascii() and self.direct if w.isalpha() else None].append(w)
        for kind, how, step in ((True, self._plain, 20_000), (False, self._line, LINE_WORDS), (None, self._each, 20_000)):
            for i in range(0, len(kinds[kind]), step):
                self.store.learn(kinds[kind][i:i + step], *how(kinds[kind][i:i + step]))
        numbers[at] = [known[w] for w in new]
        return numbers

    def _plain(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for lower-case words of a to z, which only the model itself changes."""
        ids = [[t.id for t in self.model.tokenize(w)] for w in words]
        return np.array([x for y in ids for x in y], np.int32), np.fromiter(map(len, ids), np.int64, len(ids))

    def _each(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids per word), each word encoded alone."""
        ids = self._library(words)
        return np.array([x for y in ids for x in y], np.int32), np.fromiter(map(len, ids), np.int64, len(ids))

    def _line(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for words of letters, as one line: a word is a pre-token, whose last id the model marks."""
        ids = np.array(self._library([" ".join(words)])[0], np.int32)
        ends = np.flatnonzero(self.ends[ids]) + 1
        if len(ends) != len(words):  # some word is no single pre-token (each is one at least)
            return self._each(words)
        return ids, np.diff(ends, prepend=0)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids per text), without end ids."""
        if len(self.store.known) > KEPT_WORDS:
            self.store = WordStore()
        texts = pc.cast(texts, pa.large_string()).fill_null("")
        parts = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        coded = pc.cast(parts.flatten(), pa.large_string()).dictionary_encode()
        word = coded.dictionary
        # plain words share the ids of their lower-case form, and commas and full stops behind a letter
        # are tokens of their own; words that may hold a special token stay as they are
        plain = pc.invert(pc.match_substring(word, "<|"))
        low = pc.if_else(plain, pc.ascii_lower(word), word)
        core = pc.utf8_rtrim(low, ".,")
        cut = pc.and_(plain, pc.match_substring_regex(core, "[a-zà-öø-ÿ]$"))
        core = pc.if_else(cut, core, low)
        tail = self._tails(low, core)
        c, t = core.dictionary_encode(), tail.dictionary_encode()
        pick = lambda d: self._numbers(d.dictionary)[d.indices.to_numpy(zero_copy_only=False)]
        both = np.stack((pick(c), pick(t)), 1) if len(word) else np.zeros((0, 2), np.int64)
        code = coded.indices.to_numpy(zero_copy_only=False)
        flat, n = self.store.expand(both[code].ravel())
        return flat, sums_by_row(n, 2 * np.diff(parts.offsets.to_numpy()))

    @staticmethod
    def _tails(low: pa.Array, core: pa.Array) -> pa.Array:
        """What stands behind the core of each word."""
        off = np.frombuffer(low.buffers()[1], np.int64)[low.offset:low.offset + len(low) + 1]
        size = pc.binary_length(core).to_numpy(zero_copy_only=False)
        n = np.diff(off) - size
        ends = np.concatenate(([0], np.cumsum(n)))
        data = np.frombuffer(low.buffers()[2] or b"", np.uint8)
        take = np.arange(ends[-1]) + np.repeat(off[:-1] + size - ends[:-1], n)
        return pa.LargeStringArray.from_buffers(len(low), pa.py_buffer(ends.astype(np.int64)),
                                                pa.py_buffer(np.ascontiguousarray(data[take])))


@lru_cache(maxsize=2)
def _word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def _blobs(flat: np.ndarray, counts: np.ndarray) -> pa.Array:
    """A binary column of consecutive runs of an array's elements."""
    off = np.concatenate(([0], np.cumsum(counts))) * flat.itemsize
    data = pa.py_buffer(np.ascontiguousarray(flat))
    if off[-1] < 1 << 31:
        return pa.BinaryArray.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(off.astype(np.int32)), data])
    return pa.Array.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(off), data]).cast(pa.binary())


def _unblob(col: pa.Array, dtype) -> tuple[np.ndarray, np.ndarray]:
    """(elements, offsets in elements) of a binary column."""
    data, off = utf8_bytes(col)
    size = np.dtype(dtype).itemsize
    return np.frombuffer(np.ascontiguousarray(data), dtype), off // size


def tokenise(df: DataFrame, tokenizer_path: str, end_id: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, ids as 16- or 32-bit integers) and, per task, one row with the counts of all ids."""
    id_type = df.schema[doc_id].dataType.simpleString()
    src = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _word_encoder(tokenizer_path)
        kind = np.uint16 if max(enc.vocab, end_id + 1) <= 1 << 16 else np.uint32
        total = np.zeros(max(enc.vocab, end_id + 1), np.int64)
        id_arrow = None
        for b in gathered(batches, "text", 2 * WORD_SLICE_BYTES):
            id_arrow = b.column(0).type
            flat, n = enc.encode(b.column(1))
            ends = np.cumsum(n)
            flat = np.insert(flat, ends, end_id)
            total += np.bincount(flat, minlength=len(total))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), _blobs(flat.astype(kind), n + 1), pa.nulls(b.num_rows, pa.binary())],
                ["doc_id", "ids", "counts"])
        if id_arrow is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, id_arrow), pa.nulls(1, pa.binary()), pa.array([total.tobytes()], pa.binary())],
                ["doc_id", "ids", "counts"])

    return src.mapInArrow(run, f"doc_id {id_type}, ids binary, counts binary")


def rank_ids(tokens: DataFrame) -> np.ndarray:
    """Token ids by falling count (ties: smaller id); as many as the vocabulary has, which bounds the collect."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            for x in b.column(0).to_pylist():
                got = np.frombuffer(x, np.int64)
                total = got.copy() if total is None else total + got
        if total is not None:
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["id", "n"])

    rows = (tokens.where("counts is not null").select("counts").mapInArrow(run, "id long, n long")
            .groupBy("id").agg(F.sum("n").alias("n")).toPandas())
    if not len(rows):
        return np.zeros(0, np.uint32)
    order = np.lexsort((rows["id"].to_numpy(), -rows["n"].to_numpy(np.int64)))
    return rows["id"].to_numpy(np.uint32)[order]


def encode_ranks(ranks: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(control bytes, control bytes per document, data bytes, data bytes per document)."""
    size = 1 + (ranks >= 1 << 8).astype(np.uint8) + (ranks >= 1 << 16) + (ranks >= 1 << 24)
    le = ranks.astype("<u4").view(np.uint8).reshape(-1, 4)
    data = le[np.arange(4) < size[:, None]]
    n_control = (counts + 3) // 4
    start = np.cumsum(counts) - counts
    slot = np.arange(len(ranks)) + np.repeat(4 * (np.cumsum(n_control) - n_control) - start, counts)
    bits = np.zeros(4 * int(n_control.sum()), np.uint8)
    bits[slot] = size - 1
    quad = bits.reshape(-1, 4)
    control = quad[:, 0] | quad[:, 1] << 2 | quad[:, 2] << 4 | quad[:, 3] << 6
    return control.astype(np.uint8), n_control, data, sums_by_row(size.astype(np.int64), counts)


#: Lengths of the four ids of every control byte.
_LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3).astype(np.uint8) + 1


def decode_ranks(control: np.ndarray, counts: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Ranks of documents from their control and data bytes, by table lookup."""
    n_control = (counts + 3) // 4
    start = np.cumsum(counts) - counts
    slot = np.arange(int(counts.sum())) + np.repeat(4 * (np.cumsum(n_control) - n_control) - start, counts)
    size = _LENGTHS[control].ravel()[slot]
    at = np.cumsum(size, dtype=np.int64) - size
    out = data[at].astype(np.uint32)
    for k in (1, 2, 3):
        more = np.flatnonzero(size > k)
        if not len(more):
            break
        out[more] |= data[at[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def write_token_files(docs: DataFrame, tokenizer_path: str, end_id: int, path: str,
                      doc_id: str = "doc_id", text: str = "text") -> None:
    """Tokenise, rank and write documents in ascending id order below ``path`` (``ids`` and ``ranks``)."""
    spark = docs.sparkSession
    tokens = materialize(tokenise(docs, tokenizer_path, end_id, doc_id, text), "token-ids", TEXT_ROWS)
    id_of = rank_ids(tokens)
    rank_of = np.zeros(int(id_of.max()) + 1 if len(id_of) else 1, np.uint32)
    rank_of[id_of] = np.arange(len(id_of), dtype=np.uint32)
    table = spark.sparkContext.broadcast(rank_of)  # at most one entry per vocabulary id

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = table.value
        for b in gathered(batches, "ids"):
            flat, off = _unblob(b.column(1), kind)
            n = np.diff(off)
            control, n_control, data, n_data = encode_ranks(ranks[flat], n)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n), _blobs(control, n_control), _blobs(data, n_data)],
                ["doc_id", "n_tokens", "control", "data"])

    kind = np.uint32 if _vocab(tokenizer_path, end_id) > 1 << 16 else np.uint16
    id_type = tokens.schema["doc_id"].dataType.simpleString()
    # in order before they are coded, so that finding the ranges reads stored ids only; the hash spreads equal and null ids
    rows = tokens.where("ids is not null").select("doc_id", F.xxhash64("ids").alias("h"), "ids")
    rows = rows.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h", "ids").select("doc_id", "ids")
    (rows.mapInArrow(run, f"doc_id {id_type}, n_tokens long, control binary, data binary")
     .withColumn("position", F.monotonically_increasing_id())
     .write.option("compression", "none").parquet(f"{path}/ids"))
    spark.createDataFrame([(int(r), int(i)) for r, i in enumerate(id_of.tolist())] or [], "rank long, id long") \
        .coalesce(1).write.parquet(f"{path}/ranks")


def _vocab(tokenizer_path: str, end_id: int) -> int:
    return max(_word_encoder(tokenizer_path).vocab, end_id + 1)


def read_token_files(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Documents of the files: doc_id, start (ids before it), n_tokens, ids_crc32 and, if asked for, the ids."""
    rows = spark.read.parquet(f"{path}/ranks").toPandas()  # one row per used vocabulary id
    id_of = np.zeros(len(rows), np.uint32)
    id_of[rows["rank"].to_numpy()] = rows["id"].to_numpy(np.uint32)
    table = spark.sparkContext.broadcast(id_of)
    files = spark.read.parquet(f"{path}/ids")
    id_type = files.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_by_rank = table.value
        for b in gathered(batches, "data"):
            n = b.column(2).to_numpy(zero_copy_only=False)
            control, _ = _unblob(b.column(3), np.uint8)
            data, _ = _unblob(b.column(4), np.uint8)
            ids = ids_by_rank[decode_ranks(control, n, data)].astype("<u4")
            at = np.concatenate(([0], np.cumsum(n)))
            view = memoryview(ids.view(np.uint8))
            crc = [zlib.crc32(view[4 * i:4 * j]) for i, j in zip(at[:-1].tolist(), at[1:].tolist())]
            cols = [b.column(0), b.column(1), b.column(2), pa.array(crc, pa.int64())]
            names = ["doc_id", "position", "n_tokens", "ids_crc32"]
            if with_ids:
                cols.append(pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids.astype(np.int64))))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names)

    out = files.select("doc_id", "position", "n_tokens", "control", "data").mapInArrow(
        run, f"doc_id {id_type}, position long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else ""))
    part = F.shiftright("position", 33)
    parts = files.groupBy(part.alias("part")).agg(F.sum("n_tokens").alias("n"))  # one row per written file
    before = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    inside = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("position")) - F.col("n_tokens")
    return (out.withColumn("part", part).withColumn("inside", inside)
            .join(F.broadcast(before), "part")
            .select("doc_id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32",
                    *(["ids"] if with_ids else [])))


def token_files(docs: DataFrame, tokenizer_path: str, end_id: int, path: str | None = None,
                doc_id: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """Write the files (below the shared scratch folder unless ``path`` is given) and read them back."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "token-files")
    write_token_files(docs, tokenizer_path, end_id, path, doc_id, text)
    return read_token_files(spark, path, with_ids)
