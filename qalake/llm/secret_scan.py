"""Secrets in texts and in the layers that are encoded inside them.

The base patterns (assignments of passwords and the like, access key ids, long
hexadecimal runs) are matched in the text itself. Then a worklist unwraps layers:
percent and Unicode escapes are resolved in place, runs of base64 letters are
decoded, decoded bytes that are compressed are inflated, and each new layer is
scanned and unwrapped again until nothing is left to unwrap. A layer's characters
know the range of the text that they came from, so what a layer holds is reported
where it stands in the text. A layer that already was seen with the same place is
not entered again (compressed data that unpack to themselves end there).

The worklist goes depth first. An escape chain of one kind (``%25252F``) is
resolved in one step; a compressed layer is inflated and scanned in overlapping
pieces, so memory stays bounded by the text and a few pieces.

Most texts hold nothing to look at: byte arrays of many texts together show which
hold a pattern's beginnings, escapes, or a base64 run whose bytes could be a layer
of interest.

Edge cases. Null and empty texts have no spans. Offsets are code points, ends
exclusive. Base spans always stay; a span of a layer is added unless a span of its
kind covers it. Damaged compressed data count as far as they unpack. A secret
longer than ``CARRY`` bytes on the border of two inflated pieces is reported for
the parts in each. Rows are independent, so repeated rows and null ids each keep
their row; empty tables give empty results and other columns do not take part.
"""

from __future__ import annotations

import base64
import binascii
import bz2
import hashlib
import io
import lzma
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qalake.llm.common import slices, utf8_bytes

KINDS = ("assign", "access", "hex")
#: Characters of an inflated piece, and of the overlap of two pieces.
PIECE, CARRY = 1 << 20, 1 << 12
#: Letters of a base64 run at least: twelve bytes.
RUN = 16

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
_ACCESS = re.compile("AKIA[A-Z0-9]{12,}")
_HEX = re.compile("[0-9a-f]{32,}")
Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """Matches of the base patterns by start, then kind; leftmost and without overlap within a kind."""
    out = [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    out += [("access", *m.span()) for m in _ACCESS.finditer(text)]
    out += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return sorted(out, key=_order)


def _order(s: Span) -> tuple[int, int, int]:
    return s[1], KINDS.index(s[0]), s[2]


@dataclass
class Layer:
    """A decoded text; character i came from the range [start[i], end[i]) of the document."""

    text: str
    start: np.ndarray
    end: np.ndarray
    name: str = ""

    def place(self, a: int, b: int) -> tuple[int, int]:
        return int(self.start[a:b].min()), int(self.end[a:b].max())


#: Percent escapes, and Unicode escapes by backslash, percent or character reference. An escaped escape
#: sign ("%25", "\") in front counts as one with it.
_ESCAPE = re.compile(
    r"%(?:25)*([0-9A-Fa-f]{2})|%u([0-9A-Fa-f]{4})|&#[xX]([0-9A-Fa-f]{1,6});|&#([0-9]{1,7});"
    r"|(?<!\\)\\++(?:(?:u005[cC])*u([0-9A-Fa-f]{4})|u\{([0-9A-Fa-f]{1,6})\}|x([0-9A-Fa-f]{2})|U([0-9A-Fa-f]{8}))")
_DECIMAL = 4  # the group of decimal references


def _escaped(layer: Layer) -> Layer | None:
    """The layer with its escapes resolved; None if it has none."""
    parts, keep, heads = [], [], []
    at = 0
    for m in _ESCAPE.finditer(layer.text):
        g = m.lastindex
        code = int(m[g], 10 if g == _DECIMAL else 16)
        parts += [layer.text[at:m.start()], chr(code) if code < 0x110000 and not 0xD800 <= code < 0xE000 else "�"]
        keep.append(m.span())
        heads.append(m.start())
        at = m.end()
    if not keep:
        return None
    parts.append(layer.text[at:])
    a, b = np.array(keep).T
    gone = np.zeros(len(layer.text) + 1, np.int64)  # an escape leaves its first character's place
    np.add.at(gone, a + 1, 1)
    np.add.at(gone, b, -1)
    stays = np.cumsum(gone[:-1]) == 0
    end = layer.end.copy()
    end[a] = layer.end[b - 1]
    return Layer("".join(parts), layer.start[stays], end[stays], layer.name + ">escape")


_B64 = np.zeros(256, bool)
_B64[[*range(48, 58), *range(65, 91), *range(97, 123), *map(ord, "+/-_")]] = True
_URLSAFE = bytes.maketrans(b"-_", b"+/")
#: Letters of a line at least where base64 is broken into lines.
LINE = 60
# lines as mail and key files break them, or one run
_SEGMENT = re.compile(rf"(?<![A-Za-z0-9+/_-])(?:(?:[A-Za-z0-9+/_-]{{{LINE},76}}\r?\n)+[A-Za-z0-9+/_-]*|[A-Za-z0-9+/_-]{{{RUN},}})")
_INNER = re.compile(rb"[-+/_]")


def _decoded(run: bytes) -> bytes:
    """The bytes of a run of base64 letters of either alphabet, without a last odd letter."""
    run = run.translate(_URLSAFE)
    n = len(run) - (len(run) % 4 == 1)
    try:
        return base64.b64decode(run[:n] + b"=" * (-n % 4))
    except binascii.Error:
        return b""


def _runs(run: bytes) -> Iterator[tuple[int, bytes]]:
    """A run, and its parts between signs that may be separators: (offset, bytes)."""
    yield 0, run
    if _INNER.search(run):
        at = 0
        for part in _INNER.split(run):
            if RUN <= len(part) < len(run):
                yield at, part
            at += len(part) + 1


# what decoded bytes must hold to be a layer of interest: something a pattern or a further layer begins with
_HINT = re.compile(
    rb"[0-9a-f]{32}|AKIA|(?i:passw|secret|token|api_?key)|%[0-9A-Fa-fu][0-9A-Fa-f]|\\[uUx]|&#|[A-Za-z0-9+/_-]{16}"
    rb"|\A(?:\x1f\x8b\x08|x[\x01\x5e\x9c\xda]|BZh[1-9]|\xfd7zXZ\0|\x28\xb5\x2f\xfd)|(?:[\x20-\x7e]\0){8}")


_DAMAGED = (OSError, EOFError, ValueError, zlib.error, lzma.LZMAError, zstandard.ZstdError)


class _Joined(io.RawIOBase):
    """A readable file of byte pieces."""

    def __init__(self, pieces: Iterator[bytes]):
        self.pieces, self.left = pieces, b""

    def readable(self) -> bool:
        return True

    def readinto(self, out) -> int:
        while not self.left:
            piece = next(self.pieces, None)
            if piece is None:
                return 0
            self.left = piece
        n = min(len(out), len(self.left))
        out[:n], self.left = self.left[:n], self.left[n:]
        return n


class _Deflated:
    """The reader of zlib and gzip data."""

    def __init__(self, file: io.RawIOBase):
        self.file, self.unpack = file, zlib.decompressobj(47)

    def read(self, n: int) -> bytes:
        while not self.unpack.eof:
            data = self.unpack.unconsumed_tail or self.file.read(1 << 16)
            got = self.unpack.decompress(data, n)
            if got or not data:
                return got
        return b""


def _reader(head: bytes, pieces: Iterator[bytes]):
    """A reader of the unpacked data, by what compressed data begin with; None if no format does."""
    file = _Joined(pieces)
    if head[:3] == b"\x1f\x8b\x08" or head[:2] in (b"x\x01", b"x\x5e", b"x\x9c", b"x\xda"):
        return _Deflated(file)
    if head[:3] == b"BZh":
        return bz2.BZ2File(io.BufferedReader(file))
    if head[:6] == b"\xfd7zXZ\0":
        return lzma.LZMAFile(io.BufferedReader(file))
    if head[:4] == b"\x28\xb5\x2f\xfd":
        return zstandard.ZstdDecompressor().stream_reader(file)
    return None


def _pieces(reader) -> Iterator[bytes]:
    """What a reader unpacks, up to damaged data."""
    while True:
        try:
            piece = reader.read(PIECE)
        except _DAMAGED:
            return
        if not piece:
            return
        yield piece


def _inflated(data: bytes) -> tuple[int, Iterator[bytes]]:
    """(number of compressed layers, pieces of the innermost). Data that unpack to their own head again end there."""
    depth, pieces, seen = 0, iter((data,)), set()
    while True:
        head = next(pieces, b"")
        pieces = chain((head,), pieces)
        mark = hashlib.blake2b(head, digest_size=16).digest()
        trial = None if mark in seen else _reader(head, iter((head,)))
        if trial is None or next(_pieces(trial), None) is None:
            return depth, pieces
        seen.add(mark)
        depth, pieces = depth + 1, _pieces(_reader(head, pieces))


def _byte_layers(data: bytes, start: np.ndarray, end: np.ndarray, name: str) -> Iterator[Layer]:
    """The layers that decoded bytes are: inflated pieces, 16-bit text, or the bytes themselves."""
    depth, pieces = _inflated(data)
    if depth:
        a, b, carry = np.int64(start.min()), np.int64(end.max()), b""
        for piece in pieces:
            piece = carry + piece
            yield Layer(piece.decode("latin-1"), np.broadcast_to(a, len(piece)), np.broadcast_to(b, len(piece)),
                        name + depth * ">inflate")
            carry = piece[-CARRY:]
    elif len(data) >= 8 and not any(data[1::2]):
        n = len(data) // 2
        yield Layer(data[:2 * n:2].decode("latin-1"), start[:2 * n:2], end[1:2 * n:2], name + ">utf16")
    else:
        yield Layer(data.decode("latin-1"), start, end, name)


_PACKED = re.compile(r"\x1f\x8b\x08|x[\x01\x5e\x9c\xda]|BZh[1-9]1AY|\xfd7zXZ\0|\x28\xb5\x2f\xfd")


def _packed_escapes(layer: Layer) -> Iterator[Layer]:
    """Layers of compressed bytes that were written as escapes: up to white space that was not."""
    done = 0
    for m in _PACKED.finditer(layer.text):
        if m.start() < done:
            continue
        at = m.start()
        while at < len(layer.text) and layer.text[at] < "Ā" and not (
                layer.text[at].isspace() and layer.end[at] - layer.start[at] == 1):
            at += 1
        data = layer.text[m.start():at].encode("latin-1")
        if _inflated(data)[0]:
            done = at
            yield from _byte_layers(data, layer.start[m.start():at], layer.end[m.start():at], layer.name)


def _inner_layers(layer: Layer) -> Iterator[Layer]:
    """The layers of a layer's base64 segments, and of compressed bytes among its escapes."""
    if layer.name.endswith(">escape"):
        yield from _packed_escapes(layer)
    for m in _SEGMENT.finditer(layer.text):
        raw = m.group().encode()
        whole = raw.replace(b"\r", b"").replace(b"\n", b"")
        places = np.arange(m.start(), m.end())
        if len(whole) < len(raw):
            places = places[~np.isin(np.frombuffer(raw, np.uint8), (10, 13))]
        for off, run in _runs(whole):
            data = _decoded(run)
            if data and _HINT.search(data):
                bit = 8 * np.arange(len(data))
                at = places[off:]
                yield from _byte_layers(data, layer.start[at[bit // 6]], layer.end[at[(bit + 7) // 6]], layer.name + ">base64")


class _Cover:
    """Spans by kind; says whether one covers another."""

    def __init__(self, spans: list[Span]):
        self.spans = {k: [(a, b) for kind, a, b in spans if kind == k] for k in KINDS}

    def add(self, kind: str, a: int, b: int) -> bool:
        own = self.spans[kind]
        if any(x <= a and b <= y for x, y in own):
            return False
        own.append((a, b))
        return True


def scan_text(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, layer) of a text's secrets by start, then kind; the layer of base spans is empty."""
    base = base_spans(text)
    found = [(*s, "") for s in base]
    cover = _Cover(base)
    places = np.arange(len(text) + 1)
    root = Layer(text, places[:-1], places[1:])
    seen: set[tuple[bytes, int, int]] = set()
    work: list[Iterator[Layer]] = [iter((root,))]
    while work:
        layer = next(work[-1], None)
        if layer is None:
            work.pop()
            continue
        if not layer.text:
            continue
        if layer.name:
            key = (hashlib.blake2b(layer.text.encode("utf-8", "surrogatepass"), digest_size=16).digest(),
                   int(layer.start.min()), int(layer.end.max()))
            if key in seen:
                continue
            seen.add(key)
            for kind, a, b in base_spans(layer.text):
                a, b = layer.place(a, b)
                if cover.add(kind, a, b):
                    found.append((kind, a, b, layer.name[1:]))
        work.append(_inner_layers(layer))
        plain = _escaped(layer)
        if plain is not None:
            work.append(iter((plain,)))
    return sorted(found, key=_order)


#: Beginnings of patterns and escapes, as lower-case bytes.
_NEEDLES = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key", b"akia", b"\\u", b"\\x", b"&#")
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_HEX_DIGIT = np.zeros(256, bool)
_HEX_DIGIT[[*range(48, 58), *range(97, 103)]] = True


def _long_runs(inside: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of at least ``least`` true places."""
    edge = np.flatnonzero(np.diff(inside.view(np.int8), prepend=0, append=0))
    start, end = edge[::2], edge[1::2]
    long = end - start >= least
    return start[long], end[long]


def _suspects(texts: pa.Array) -> np.ndarray:
    """Rows that may hold a secret or a layer; found on the bytes of all rows together."""
    data, off = utf8_bytes(texts)
    n = len(off) - 1
    spaced = np.zeros(len(data) + n, np.uint8)  # a zero byte behind every row
    spaced[np.arange(len(data)) + np.repeat(np.arange(n), np.diff(off))] = data
    off = off + np.arange(n + 1)
    flat, low = spaced.tobytes(), _FOLD[spaced]
    folded = low.tobytes()
    at: list[int] = []
    for needle in _NEEDLES:
        x = folded.find(needle)
        while x >= 0:
            at.append(x)
            x = folded.find(needle, x + 1)
    percent = np.flatnonzero(spaced == 37)  # a row's end follows
    hex_digit = _HEX_DIGIT[low]
    percent = percent[(hex_digit | (low == 117))[percent + 1]]
    start, end = _long_runs(_B64[spaced], RUN)
    for a, b in zip(start.tolist(), end.tolist()):
        for _, run in _runs(flat[a:b]):
            got = _decoded(run)
            if _HINT.search(got) or (len(run) >= LINE and got.isascii()):
                at.append(a)
                break
    found = np.concatenate((np.array(at, np.int64), _long_runs(hex_digit, 32)[0], percent))
    return np.unique(np.searchsorted(off, found, side="right") - 1)


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, spans): each document's secrets by start, then kind, with the layer that holds them ('' is the text)."""
    kind = docs.schema[doc_id].dataType.simpleString()
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("layer", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            spans: list[list[dict]] = [[] for _ in range(b.num_rows)]
            texts = b.column(1)
            for i in _suspects(texts).tolist():
                spans[i] = [{"kind": k, "start": a, "end": e, "layer": how} for k, a, e, how in scan_text(texts[i].as_py() or "")]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(spans, pa.list_(span))], ["doc_id", "spans"])

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, f"doc_id {kind}, spans array<struct<kind:string,start:long,end:long,layer:string>>")


def redact_text(text: str, spans: list[tuple[str, int, int, str]]) -> str:
    """The text with each span (the first of those that overlap) replaced by its kind in brackets."""
    out, at = [], 0
    for k, a, b, _ in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"[{k}]"]
        at = max(at, b)
    return "".join(out) + text[at:]
