"""SentencePiece encoding and decoding of whole texts.

Encoding is a batched dynamic programme in numpy. A text is cut into words
(a blank starts a word), equal-length words of a batch advance together, every
substring's hash probes the sorted hashes of the pieces of its length, and
vectorised maxima store the backpointer of each word position.

The public model is a BPE model, whose scores are merge ranks, so the path of
the greatest score sum is not what the model's own merges give. The recurrence
therefore runs over *admissible* steps only: a piece may follow the last piece
of the best path before it if merging never joins or cuts the two (checked by
undoing the later merge of the two, over and over). There is one admissible
path per position, and it is the merge order's result. Unigram models take the
path with the greatest score sum.

Long words without a blank (base64, minified code) are cut into overlapping windows
that advance together as equal-length rows. Two windows are joined where both have a
piece border and the pieces that meet there are admissible: the joined path is
admissible everywhere, so it is the one path of the word. Where two windows share
no such border they are made larger. (Only for merge models; others advance whole.)

Edge cases. Null and empty texts have no ids and decode to the empty string.
Characters outside the vocabulary become byte pieces. Runs of blanks merge from
the left, as equal scores do. Texts of any length are encoded whole. U+2581 in
a text decodes to a blank, as in the model's own library. Rows are independent,
so repeated rows give repeated results and empty tables empty ones; other
columns pass through (a clashing result column is replaced).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from qalake.llm.common import U64, WORD_SLICE_BYTES, WordStore, gathered, mix64, prefix_sums, span_hashes, sums_by_row

SPACE = "▁"
#: Words that one task keeps with their ids (a bound on its memory; the results do not depend on it).
KEPT_WORDS = 400_000
#: The same for their ids.
KEPT_IDS = 1 << 24
#: Words above this length are first cut where no merge can cross.
LONG_WORD = 20
#: Characters of a window of a longer part, and characters that two windows share, at first.
WINDOW, SHARED = 512, 128
_POINT = U64(0xD1342543DE82EF95)


def _point_sums(points: np.ndarray) -> np.ndarray:
    return prefix_sums(mix64((points.astype(U64) + U64(1)) * _POINT))


@dataclass
class Model:
    """Tables of a SentencePiece model for numpy: pieces by length and hash, ranks, splits."""

    pieces: list[str]
    merges: bool
    score: np.ndarray
    unk: int
    byte_ids: np.ndarray
    by_len: dict[int, tuple[np.ndarray, np.ndarray]] = field(default_factory=dict)
    chars: dict[str, int] = field(default_factory=dict)
    rank: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    left: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    right: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    pair_keys: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    pair_rank: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    runs: dict[int, int] = field(default_factory=dict)
    bigrams: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    blob: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint8))
    blob_at: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))


@lru_cache(maxsize=2)
def load_model(path: str) -> Model:
    """Read a model file and build its tables (once per Python process)."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    if sp.normalize("a  B\tﬁ ") != f"{SPACE}a{SPACE}{SPACE}B\tﬁ{SPACE}":
        raise ValueError("only models without text normalisation and with a leading blank are supported")
    n = sp.get_piece_size()
    pieces = [sp.id_to_piece(i) for i in range(n)]
    plain = [not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)) for i in range(n)]
    byte_ids = np.full(256, sp.unk_id(), np.int64)
    for i in range(n):
        if sp.is_byte(i):
            byte_ids[int(pieces[i][3:-1], 16)] = i
    score = np.array([sp.get_score(i) for i in range(n)])
    used = [i for i in range(n) if plain[i]]
    whole = [i for i in used if len(pieces[i]) > 1 and set(pieces[i]) != {SPACE}]
    merges = bool(len(whole)) and all(float(score[i]).is_integer() for i in whole)
    m = Model(pieces, merges, score, sp.unk_id(), byte_ids)
    m.chars = {pieces[i]: i for i in used if len(pieces[i]) == 1}
    m.runs = {len(pieces[i]): i for i in used if set(pieces[i]) == {SPACE}}
    seen = {(ord(a), ord(b)) for i in whole for a, b in zip(pieces[i], pieces[i][1:])}
    m.bigrams = np.array(sorted(a << 32 | b for a, b in seen), np.int64)
    if merges:
        _merge_tables(m, whole)
        whole = [i for i in whole if m.rank[i] >= 0]
    for i in [*m.chars.values(), *whole]:
        m.by_len.setdefault(len(pieces[i]), []).append(i)  # type: ignore[union-attr]
    for size, ids in m.by_len.items():
        points = np.array([[ord(c) for c in pieces[i]] for i in ids], np.int64).ravel()
        sums = _point_sums(points)
        at = np.arange(len(ids)) * size
        h = span_hashes(sums, at, at + size)
        order = np.argsort(h)
        m.by_len[size] = (h[order], np.array(ids, np.int64)[order])
    out = [bytes([int(p[3:-1], 16)]) if byte_ids[0] != sp.unk_id() and sp.is_byte(i)
           else (b"" if sp.is_control(i) else p.replace(SPACE, " ").encode()) for i, p in enumerate(pieces)]
    out[sp.unk_id()] = " ⁇ ".encode()
    m.blob = np.frombuffer(b"".join(out), np.uint8)
    m.blob_at = np.concatenate(([0], np.cumsum([len(x) for x in out])))
    return m


def _merge_tables(m: Model, whole: list[int]) -> None:
    """Ranks and the last merge of every piece; pieces that merging cannot reach get rank -1."""
    n = len(m.pieces)
    m.rank, m.left, m.right = (np.full(n, -1, np.int64) for _ in range(3))
    ids = {m.pieces[i]: i for i in whole}
    rank_of = {i: int(-m.score[i]) for i in whole}
    pairs: dict[tuple[int, int], int] = {}
    for i in sorted(whole, key=rank_of.__getitem__):
        syms = [m.chars.get(c) for c in m.pieces[i]]
        if None in syms:
            continue
        last = None
        texts = list(m.pieces[i])
        while len(syms) > 1:
            best = None
            for k in range(len(syms) - 1):
                got = ids.get(texts[k] + texts[k + 1])
                if got is not None and (best is None or rank_of[got] < best[0]):
                    best = (rank_of[got], k, got)
            if best is None:
                break
            _, k, got = best
            last = (syms[k], syms[k + 1])
            syms[k:k + 2] = [got]
            texts[k:k + 2] = [texts[k] + texts[k + 1]]
        if syms == [i]:
            m.rank[i], (m.left[i], m.right[i]) = rank_of[i], last
    for i in whole:  # every cut of a piece into two pieces is a merge that may happen
        if m.rank[i] >= 0:
            s = m.pieces[i]
            for k in range(1, len(s)):
                a = m.chars.get(s[:k]) if k == 1 else ids.get(s[:k])
                b = m.chars.get(s[k:]) if len(s) - k == 1 else ids.get(s[k:])
                if a is not None and b is not None:
                    pairs[a, b] = rank_of[i]
    keys = np.array([a * n + b for a, b in pairs], np.int64)
    order = np.argsort(keys)
    m.pair_keys, m.pair_rank = keys[order], np.array(list(pairs.values()), np.int64)[order]


def _follows(m: Model, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether merging the text of pieces a and b gives just a and b.

    Undoes the later of the two pieces that meet until single characters meet;
    a merge across the border that comes before the one undone last refutes it.
    """
    n, none = len(m.pieces), np.iinfo(np.int64).max
    ok = np.ones(len(a), bool)
    at = np.arange(len(a))
    a, b, limit = a.copy(), b.copy(), np.full(len(a), none)
    while len(at):
        key = a * n + b
        pos = np.minimum(np.searchsorted(m.pair_keys, key), max(len(m.pair_keys) - 1, 0))
        joined = (m.pair_keys[pos] == key) & (m.pair_rank[pos] < limit) if len(m.pair_keys) else np.zeros(len(at), bool)
        ok[at[joined]] = False
        ra, rb = m.rank[a], m.rank[b]
        go = ~joined & ((ra >= 0) | (rb >= 0))
        at, a, b, limit, ra, rb = (x[go] for x in (at, a, b, limit, ra, rb))
        cut = ra > rb
        limit = np.where(cut, ra, rb + 1)  # of equal ranks the left merge comes first
        a, b = np.where(cut, m.right[a], a), np.where(cut, b, m.left[b])
    return ok


class _Pairs:
    """Answers of ``_follows``, kept in a table of fixed size by the hash of the pair."""

    BITS = 21

    def __init__(self, m: Model):
        self.m = m
        self.keys, self.vals = np.full(1 << self.BITS, -1, np.int64), np.zeros(1 << self.BITS, bool)

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a * len(self.m.pieces) + b
        slot = ((key.astype(U64) * U64(0x9E3779B97F4A7C15)) >> U64(64 - self.BITS)).astype(np.int64)
        out = self.vals[slot]
        new = np.flatnonzero(self.keys[slot] != key)
        if len(new):
            out[new] = _follows(self.m, a[new], b[new])
            self.keys[slot[new]], self.vals[slot[new]] = key[new], out[new]
            # of two new pairs of one slot either may stay: key and answer must be of the same one
            late = new[self.keys[slot[new]] == key[new]]
            self.vals[slot[late]] = out[late]
        return out


def _probe(m: Model, sums: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Ids of the pieces that are the substrings [at, at + size), else -1."""
    keys, ids = m.by_len[size]
    h = span_hashes(sums, at, at + size)
    pos = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
    return np.where(keys[pos] == h, ids[pos], -1)


def _encode_equal(m: Model, follows: _Pairs, points: np.ndarray, rows: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, lengths) of ``rows`` words of ``size`` characters; characters outside the vocabulary get -1-point."""
    sums = _point_sums(points)
    base = np.arange(rows) * size
    tok = np.full((size + 1, rows), -1, np.int64)
    back = np.ones((size + 1, rows), np.int64)
    best = np.full((size + 1, rows), -np.inf)
    best[0] = 0.0
    grid = points.reshape(rows, size)
    for end in range(1, size + 1):
        for n in sorted(m.by_len):
            if n > end:
                break
            got = _probe(m, sums, base + end - n, n)
            at = np.flatnonzero(got >= 0)
            if not len(at):
                continue
            start = end - n
            if m.merges:
                at = at[best[start, at] == 0.0]
                prev = tok[start, at]
                fits = np.ones(len(at), bool)
                inner = prev >= 0  # unknown characters and the word's start meet any piece
                fits[inner] = follows(prev[inner], got[at][inner])
                at = at[fits]
                value = np.zeros(len(at))
            else:
                value = best[start, at] + m.score[got[at]]
            better = value > best[end, at]
            at = at[better]
            best[end, at] = value[better]
            tok[end, at] = got[at]
            back[end, at] = n
        lost = np.flatnonzero(np.isneginf(best[end]))
        if len(lost):  # a character outside the vocabulary
            known = np.array([chr(c) in m.chars for c in grid[lost, end - 1]], bool)
            out = lost[~known]
            best[end, out] = best[end - 1, out] - (0.0 if m.merges else 1e6)
            tok[end, out] = -1 - grid[out, end - 1]
            back[end, out] = 1
    ids = np.full((rows, size), np.iinfo(np.int64).min)
    pos = np.full(rows, size)
    live = np.arange(rows)
    while len(live):
        p = pos[live]
        ids[live, p - 1] = tok[p, live]
        pos[live] = p - back[p, live]
        live = live[pos[live] > 0]
    keep = ids != np.iinfo(np.int64).min
    return ids[keep], keep.sum(1)


class Encoder:
    """Encodes batches of texts; keeps the ids of words between batches."""

    def __init__(self, path: str):
        self.m = load_model(path)
        self.follows = _Pairs(self.m)
        self.store = WordStore()
        self._run: dict[int, list[int]] = {}

    def _word_ids(self, words: list[str]) -> None:
        """Add the ids of words (each with its leading blank) to the kept ones."""
        by: dict[int, list[str]] = {}
        cut: dict[str, list[str]] = {}
        for w in words:
            if len(w) > LONG_WORD and len(parts := self._fragments(w)) > 1:
                cut[w] = parts
            else:
                by.setdefault(len(w), []).append(w)
        for part in {x for parts in cut.values() for x in parts}:
            if part not in self.store.known:
                by.setdefault(len(part), []).append(part)
        for size in [k for k in by if k > WINDOW and self.m.merges]:
            for w in by.pop(size):
                ids = self._windows(w)
                self.store.learn([w], *self._bytes(ids, np.array([len(ids)])))
        self._equal_words(by)
        for w, parts in cut.items():
            ids, n = self.store.expand(np.array([self.store.known[x] for x in parts]))
            self.store.learn([w], ids, np.array([n.sum()]))

    def _fragments(self, word: str) -> list[str]:
        """Cut a word between characters that no piece holds side by side: nothing merges there."""
        c = np.frombuffer(word.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        key = c[:-1] << 32 | c[1:]
        pos = np.minimum(np.searchsorted(self.m.bigrams, key), max(len(self.m.bigrams) - 1, 0))
        apart = self.m.bigrams[pos] != key if len(self.m.bigrams) else np.ones(len(key), bool)
        at = [0, *(np.flatnonzero(apart) + 1).tolist(), len(word)]
        return [word[a:b] for a, b in zip(at, at[1:])]

    def _windows(self, word: str) -> np.ndarray:
        """Ids of a long word (characters outside the vocabulary as -1-point), from overlapping windows."""
        points = np.frombuffer(word.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        size, shared = WINDOW, SHARED
        while size < len(points):
            start = np.append(np.arange(0, len(points) - size, size - shared), len(points) - size)
            joined = self._join(start, self._window_paths(points, start, size), size)
            if joined is not None:
                return joined
            size, shared = 4 * size, 4 * shared
        return _encode_equal(self.m, self.follows, points, 1, len(points))[0]

    def _window_paths(self, points: np.ndarray, start: np.ndarray, size: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """(ids, ends of the pieces in the word) of each window."""
        width, out = np.array([len(p) for p in self.m.pieces]), []
        step = max(1, 2_000_000 // (8 * size))
        for i in range(0, len(start), step):
            part = start[i:i + step]
            ids, n = _encode_equal(self.m, self.follows, points[part[:, None] + np.arange(size)].ravel(), len(part), size)
            ends = np.cumsum(np.where(ids < 0, 1, width[ids]))  # the windows stand one behind the other here
            at = np.cumsum(n) - n
            out += [(ids[a:a + k], ends[a:a + k] - j * size + s) for j, (s, a, k) in enumerate(zip(part.tolist(), at.tolist(), n.tolist()))]
        return out

    def _join(self, start: np.ndarray, paths: list[tuple[np.ndarray, np.ndarray]], size: int) -> np.ndarray | None:
        """One path from those of overlapping windows; None if two of them share no admissible border."""
        out, done = [], 0  # pieces of the next window up to the border that was found last stay out
        for k, (ids, ends) in enumerate(paths):
            if k + 1 == len(paths):
                out.append(ids[done:])
                break
            after, its_ends = paths[k + 1]
            # borders of both: an end here, a start there (its first piece starts where the window does: no border)
            border, here, there = np.intersect1d(ends, its_ends, return_indices=True)
            inside = (there + 1 < len(after)) & (here + 1 < len(ids)) & (here >= done)
            border, here, there = border[inside], here[inside], there[inside] + 1
            a, b = ids[here], after[there]
            fits, known = np.ones(len(a), bool), (a >= 0) & (b >= 0)
            fits[known] = self.follows(a[known], b[known])
            if not fits.any():
                return None
            middle = (start[k + 1] + start[k] + size) / 2
            best = np.flatnonzero(fits)[np.abs(border[fits] - middle).argmin()]
            out.append(ids[done:here[best] + 1])
            done = int(there[best])
        return np.concatenate(out)

    def _equal_words(self, by: dict[int, list[str]]) -> None:
        for size, group in by.items():
            group = list(dict.fromkeys(group))
            step = max(1, 2_000_000 // max(size * 8, 1))
            for i in range(0, len(group), step):
                part = group[i:i + step]
                points = np.frombuffer("".join(part).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
                ids, n = _encode_equal(self.m, self.follows, points, len(part), size)
                if (ids < 0).any():
                    ids, n = self._bytes(ids, n)
                self.store.learn(part, ids, n)

    def _bytes(self, ids: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Characters outside the vocabulary as byte pieces."""
        word = np.repeat(np.arange(len(n)), n)
        code, which = np.unique(ids, return_inverse=True)
        have = (self.m.byte_ids != self.m.unk).any()
        lists = [[c] if c >= 0 else [int(self.m.byte_ids[x]) for x in chr(-1 - c).encode("utf-8", "surrogatepass")]
                 if have else [self.m.unk] for c in code.tolist()]
        size = np.array([len(x) for x in lists])
        flat, start = np.concatenate(lists).astype(np.int64), np.cumsum(size) - size
        k = size[which]
        ends = np.cumsum(k)
        out = flat[np.arange(ends[-1]) + np.repeat(start[which] - (ends - k), k)]
        return out, np.bincount(np.repeat(word, k), minlength=len(n))

    def _blank_run(self, n: int) -> list[int]:
        """Ids of n blanks: equal scores merge from the left."""
        if n not in self._run:
            runs, sizes = self.m.runs, []
            for _ in range(n):
                sizes.append(1)
                while len(sizes) > 1 and sizes[-2] + sizes[-1] in runs:
                    sizes[-2:] = [sizes[-2] + sizes[-1]]
            self._run[n] = [runs[s] for s in sizes]
        return self._run[n]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids per text)."""
        if self.store.rows > KEPT_WORDS or self.store.used > KEPT_IDS:
            self.store = WordStore()
        known = self.store.known
        texts = pc.cast(texts, pa.large_string()).fill_null("")
        empty = pc.equal(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        texts = pc.replace_substring(texts, SPACE, " ")
        parts = pc.split_pattern(texts, " ")
        coded = pc.cast(parts.flatten(), pa.large_string()).dictionary_encode()
        words = [SPACE + w for w in coded.dictionary.to_pylist()]
        code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        count = np.diff(parts.offsets.to_numpy())
        if empty.any():  # an empty text splits into one empty word; it has no ids
            keep = np.repeat(~empty, count)
            code = code[keep]
            count = np.where(empty, 0, count)
        new = [w for w in words if w not in known and w != SPACE]
        if new:
            self._word_ids(new)
        blank = words.index(SPACE) if SPACE in words else -1
        number = np.array([-1 if w == SPACE else known[w] for w in words], np.int64)
        if not len(code):
            return np.zeros(0, np.int32), np.zeros(len(count), np.int64)
        number = self._with_runs(number, code, count, blank) if (code == blank).any() else number[code]
        flat, n = self.store.expand(number)
        return flat, sums_by_row(n, count)

    def _with_runs(self, number, code, count, blank):
        """Word numbers with runs of blanks: an empty word lends its blank to the next word of its text.

        The last blank of a run merges with the word behind it first; the others
        merge among themselves, with the word's blank too where that stayed alone.
        """
        store, none = self.store, self.store.add(np.zeros(0, np.int32), np.array([0]))
        is_blank = code == blank
        row_end = np.zeros(len(code), bool)
        row_end[np.cumsum(count)[count > 0] - 1] = True
        out = number[code]
        seen: dict[tuple[int, int], int] = {}
        run, alone = 0, self.m.chars.get(SPACE)
        for i in np.flatnonzero(is_blank | np.concatenate(([False], is_blank[:-1] & ~row_end[:-1]))).tolist():
            if is_blank[i]:
                run += 1
                if not row_end[i]:
                    out[i] = none  # lent to the next word
                    continue
                key, ids, lone = (-1, run), np.zeros(0, np.int32), 0
            else:
                key, ids = (int(out[i]), run), store.ids_of(out[i])
                lone = int(len(ids) > 0 and ids[0] == alone)
            if key not in seen:
                ids = np.concatenate((np.array(self._blank_run(run + lone), np.int32), ids[lone:]))
                seen[key] = store.add(ids, np.array([len(ids)]))
            out[i] = seen[key]
            run = 0
        return out


#: Ids that are decoded together.
DECODED = 1 << 18


def decode_ids(m: Model, ids: np.ndarray, count: np.ndarray) -> list[str]:
    """Texts of id lists: the pieces' bytes by table lookup, without the leading blank."""
    out: list[str] = []
    ends = np.cumsum(count)
    row = at = 0
    while row < len(count):  # lists of about DECODED ids, one at least
        last = max(row + 1, int(np.searchsorted(ends, at + DECODED, side="right")))
        out += _decoded(m, ids[at:int(ends[last - 1])], count[row:last])
        row, at = last, int(ends[last - 1])
    return out


def _decoded(m: Model, ids: np.ndarray, count: np.ndarray) -> list[str]:
    n = (m.blob_at[1:] - m.blob_at[:-1])[ids]
    ends = np.cumsum(n)
    total = int(ends[-1]) if len(ends) else 0
    data = m.blob[np.arange(total) + np.repeat(m.blob_at[:-1][ids] - (ends - n), n)].tobytes() if total else b""
    at = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(count)))].tolist()
    out = []
    for a, b in zip(at, at[1:]):
        s = data[a:b]
        out.append((s[1:] if s[:1] == b" " else s).decode("utf-8", "replace"))
    return out


def encode(df: DataFrame, model_path: str, text: str = "text", ids: str = "token_ids",
           decoded: str | None = None) -> DataFrame:
    """``df`` with a column of piece ids (array of int), and the text decoded from them if ``decoded`` names a column.

    See the module's docstring for edge cases.
    """
    keep = [c for c in df.columns if c not in (ids, decoded)]
    src = df.select(*keep)
    schema = T.StructType([*src.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType(), False), False)])
    if decoded:
        schema = schema.add(decoded, T.StringType(), False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(model_path)
        for b in gathered(batches, text, WORD_SLICE_BYTES):
            flat, n = enc.encode(b.column(text))
            off = np.concatenate(([0], np.cumsum(n))).astype(np.int32)
            col = pa.ListArray.from_arrays(pa.array(off), pa.array(flat, pa.int32()))
            more, names = [col], [ids]
            if decoded:
                more.append(pa.array(decode_ids(enc.m, flat, n), pa.string()))
                names.append(decoded)
            yield pa.RecordBatch.from_arrays([*b.columns, *more], [*b.schema.names, *names])

    return src.mapInArrow(run, schema)


@lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def decode(df: DataFrame, model_path: str, ids: str = "token_ids", text: str = "decoded") -> DataFrame:
    """``df`` with the text of a column of piece ids; null lists decode to the empty text."""
    keep = [c for c in df.columns if c != text]
    src = df.select(*keep)
    schema = T.StructType([*src.schema.fields, T.StructField(text, T.StringType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = load_model(model_path)
        for big in batches:
            for i in range(0, big.num_rows, 512):
                b = big.slice(i, 512)
                col = b.column(ids)
                flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                n = pc.list_value_length(col).fill_null(0).to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(decode_ids(m, flat, n), pa.string())],
                                                 [*b.schema.names, text])

    return src.mapInArrow(run, schema)
