"""Spelling variants: words at edit distance one, found by PartEnum signatures of letter multisets.

Counting. Words are maximal runs of letters (A-Z, a-z, U+00C0 to U+00FF), A-Z
lower-cased. With ``damage``, a run whose checksum (crc32 of ``<id>:<run>``) is a
multiple of it loses the code point that the checksum names. Runs are counted in
byte arrays, combined inside each task before they are shuffled.

Pairs. A word's letters are a binary vector over (letter, how often it came
before). One inserted or deleted letter changes one place of it, a replaced one
two, so near words have vectors at Hamming distance two at most: of ``PARTS``
parts of the places one is the same in both. Besides, an edit leaves either the
first or the last half of the shorter word alone. A signature is therefore a
half, its side, the shorter length, and one part of the other letters' vector.
Each word has one set of signatures for its own length and one for partners
that are shorter by a letter; near words share one at least. Words are equi-joined on
signatures, and the join's condition verifies the distance, so that only links
leave it. Spark splits signatures that many words share.

Variants. A word's form is its near word of the greatest count, if that is at
least twice the word's own. Counts double along forms, so chains are short and
end; roots come from pointer doubling over written tables.

Edge cases. Null and empty texts have no words; null ids count as an empty id.
Repeated rows count again. Words of equal count tie towards the smaller one in
code-point order. Empty tables give empty results; other columns do not take part.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qalake.llm.common import gathered, materialize, mix64, utf8_bytes

#: Parts of a letter vector: one more than the Hamming distance of near words.
PARTS = 3
#: Different words that a task holds before it passes them on.
HELD_WORDS = 500_000

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), 0xC3]] = True  # in UTF-8, C3 and the byte behind it are U+00C0 to U+00FF
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _crc_table() -> np.ndarray:
    """The byte table of the reflected polynomial of crc32."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1)
    return t


_CRC = _crc_table()


def runs(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the letter runs; runs never cross rows."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    letter = _LETTER[data]
    letter[1:] |= data[:-1] == 0xC3
    first, last = letter.copy(), letter.copy()
    first[1:] &= ~letter[:-1]
    last[:-1] &= ~letter[1:]
    edge = off[1:-1]
    edge = edge[(edge > 0) & (edge < len(data))]
    first[edge] = letter[edge]
    last[edge - 1] = letter[edge - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def checksums(data: np.ndarray, start: np.ndarray, end: np.ndarray, state: np.ndarray) -> np.ndarray:
    """crc32 of each span behind a prefix whose crc32 is given; all spans advance a byte together."""
    size = end - start
    order = np.argsort(-size, kind="stable")
    at, crc = start[order], state[order].astype(np.uint32) ^ np.uint32(0xFFFFFFFF)
    longer = np.searchsorted(-size[order], -np.arange(int(size.max(initial=0))), side="left")  # spans of more than k bytes
    for k, n in enumerate(longer.tolist()):
        crc[:n] = _CRC[(crc[:n] ^ data[at[:n] + k]) & 0xFF] ^ (crc[:n] >> np.uint32(8))
    out = np.empty(len(size), np.uint32)
    out[order] = crc ^ np.uint32(0xFFFFFFFF)
    return out


def _take(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.LargeStringArray:
    """The spans as a string column."""
    n = end - start
    off = np.concatenate(([0], np.cumsum(n)))
    at = np.arange(off[-1]) + np.repeat(start - off[:-1], n)
    return pa.LargeStringArray.from_buffers(len(n), pa.py_buffer(off.astype(np.int64)),
                                            pa.py_buffer(np.ascontiguousarray(data[at])))


def _words(ids: pa.Array, texts: pa.Array, damage: int | None, letters: int) -> pa.Array:
    """The words of a batch with repeats."""
    data, off = utf8_bytes(texts)
    data = _LOWER[data]
    start, end = runs(data, off)
    lead = np.concatenate(([0], np.cumsum(data == 0xC3)))
    size = (end - start) - (lead[end] - lead[start])  # code points
    if not damage:
        keep = size >= letters
        return _take(data, start[keep], end[keep])
    before = np.fromiter((zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids.to_pylist()), np.uint32, len(ids))
    row = np.searchsorted(off, start, side="right") - 1
    # runs below the least length stay so, whatever their checksum
    some = np.flatnonzero(size >= letters)
    start, end, size = start[some], end[some], size[some]
    h = checksums(data, start, end, before[row[some]])
    hit = h % np.uint32(damage) == 0
    hurt = []
    for w, k in zip(_take(data, start[hit], end[hit]).to_pylist(), h[hit].tolist()):
        if len(w) > letters:
            k %= len(w)
            hurt.append(w[:k] + w[k + 1:])
    return pa.chunked_array([_take(data, start[~hit], end[~hit]), pa.array(hurt, pa.large_string())]).combine_chunks()


def word_counts(docs: DataFrame, damage: int | None = None, letters: int = 5, doc_id: str = "doc_id",
                text: str = "text") -> DataFrame:
    """Rows (word, n): the words of at least ``letters`` code points and their occurrences in all whole texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        rows = 0

        def summed() -> pa.Table:
            return pa.concat_tables(held).group_by("word").aggregate([("n", "sum")]).rename_columns(["word", "n"])

        for b in gathered(batches, "text"):
            got = pc.value_counts(_words(b.column(0), b.column(1), damage, letters))
            held.append(pa.table({"word": got.field(0), "n": got.field(1)}))
            rows += len(got)
            if rows > 4 * HELD_WORDS:
                held = [summed()]
                rows = held[0].num_rows
                if rows > HELD_WORDS:
                    yield from _plain(held[0])
                    held, rows = [], 0
        if held:
            yield from _plain(summed())

    def _plain(t: pa.Table) -> Iterator[pa.RecordBatch]:
        yield from t.set_column(0, "word", t.column("word").cast(pa.string())).to_batches(max_chunksize=65536)

    src = docs.select(F.col(doc_id).cast("string").alias("id"), F.col(text).alias("text"))
    return src.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


_PART_OF: dict[tuple[str, int], int] = {}


def _part_of(letter: str, before: int) -> int:
    """The part of the place (letter, occurrences before)."""
    at = _PART_OF.get((letter, before))
    if at is None:
        x = mix64(np.array([ord(letter) << 20 | before], np.uint64))[0]
        at = _PART_OF[letter, before] = int(x >> np.uint64(32)) % PARTS
    return at


def _parts(letters: str) -> list[str]:
    """The letter vector of a text: the letters of each part in order (how many of a letter lie in a part says which)."""
    out: list[list[str]] = [[] for _ in range(PARTS)]
    seen: Counter[str] = Counter()
    for c in sorted(letters):
        out[_part_of(c, seen[c])].append(c)
        seen[c] += 1
    return ["".join(x) for x in out]


def word_signatures(word: str) -> Iterator[tuple[str, bool]]:
    """(signature, whether it is for shorter partners) of a word."""
    for shorter in (False, True):
        n = len(word) - shorter
        head = n // 2
        tail = len(word) - (n - head)
        for side, half, rest in (("<", word[:head], word[head:]), (">", word[tail:], word[:tail])):
            for k, part in enumerate(_parts(rest)):
                yield f"{n}{side}{k}{half} {part}", shorter


def signatures(words: DataFrame) -> DataFrame:
    """Rows (signature, shorter, word, n) of words (word, n)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = 4 * PARTS
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                b = whole.slice(at, 4096)
                got = [s for w in b.column(0).to_pylist() for s in word_signatures(w)]
                again = pa.array(np.repeat(np.arange(b.num_rows), each))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([s for s, _ in got], pa.string()), pa.array([x for _, x in got], pa.bool_()),
                     b.column(0).take(again), b.column(1).take(again)], ["signature", "shorter", "word", "n"])

    return words.select("word", "n").mapInArrow(run, "signature string, shorter boolean, word string, n long")


def near_pairs(words: DataFrame) -> DataFrame:
    """Each pair (a, n_a, b, n_b) of words (word, n) that differ by one inserted, deleted or replaced code point, once."""
    rows = signatures(words)
    u = rows.where("not shorter").select("signature", F.col("word").alias("a"), F.col("n").alias("n_a"))
    v = rows.select("signature", "shorter", F.col("word").alias("b"), F.col("n").alias("n_b"))
    return (u.join(v, "signature").where("(shorter or a < b) and levenshtein(a, b, 1) = 1")
            .select("a", "n_a", "b", "n_b").distinct())


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of words (word, form): forms followed to the last, twice as far in each round."""
    at = materialize(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        on = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        far = materialize(at.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                             F.col("next").isNotNull().alias("moved")), "spelling-roots")
        at = far.select("word", "root")
        if not far.where("moved").limit(1).count():
            return at


def variants(docs: DataFrame, damage: int | None = None, letters: int = 5, least: int = 3, times: int = 2,
             doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (word, form, root, n, n_near, form_n) of the words with at least ``least`` occurrences."""
    words = materialize(word_counts(docs, damage, letters, doc_id, text).where(F.col("n") >= least), "spelling-words")
    pairs = materialize(near_pairs(words), "spelling-pairs")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("near_n")).unionAll(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_a").alias("near_n")))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"),
                                    F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    named = words.join(best, "word", "left")
    formed = (-F.col("best.less")) >= times * F.col("n")
    named = materialize(named.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(formed, F.col("best.near")).alias("form"),
        F.when(formed, -F.col("best.less")).alias("form_n")), "spelling-forms")
    roots = _roots(named.where("form is not null").select("word", "form"))
    return named.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
