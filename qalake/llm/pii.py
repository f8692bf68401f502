"""Personal data: base patterns, and further spans that boosted trees select among candidates.

High-recall generators propose overlapping candidate spans: numbers in groups (a
run of numbers side by side, and its parts between group borders), dotted or colon-separated addresses, written-out mail addresses. Each candidate
has features of its format (digits, groups, separators, checks) and of its
context (what stands beside it, words before it). Boosted trees score them.

The tables hold no marked spans, so the trees learn from the base patterns:
candidates that match one are positive, and so are copies of them in other
spellings (a phone number without its plus, an address with its dots written
out or in eight groups with colons); candidates that match none are negative. Each kind's threshold is the
least score at which ``PRECISION`` of the held-out candidates above it are
positive. Numbers beside a base match teach the borders inside a run. A selected candidate is added where it touches no base span and no
better candidate. Base spans always stay.

The trees learn from about ``TRAIN_DOCS`` documents (those with the smallest hashes
of id and text), of each kind from about ``TRAIN_ROWS`` examples (a long table of numbers has any
number of candidates; of more, equal ones are thinned out and those with the smallest hashes stay); the thresholds count the held-out candidates of all documents, and
finding looks at every whole text.

Edge cases. Null and empty texts have no spans. Offsets are code points. Every
scan is linear in the text. Without positive candidates of a kind none is added.
Rows are independent, empty tables give empty results, and other columns do not
take part (``redact`` keeps them).
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qalake.llm.boosting import BoostedTrees
from qalake.llm.common import TEXT_ROWS, materialize, slices

KINDS = ("email", "ip", "card", "phone")
#: Documents that the trees learn from at most, about as many examples of a kind, and the precision that a threshold must reach.
TRAIN_DOCS, TRAIN_ROWS, PRECISION = 20_000, 40_000, 0.99
#: Bins of a unit of log odds in which held-out examples are counted.
ODDS_BINS = 100
#: Candidates of a text whose features are held at once.
SCORED = 4096
Span = tuple[str, int, int]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGIT = re.compile("[0-9]")
_HOST = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_DIGIT = re.compile("[^0-9]+")


def luhn(digits: str) -> bool:
    """Whether the digits' check sum is right."""
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """The base patterns' matches by kind, then start; leftmost and without overlap within a kind."""
    out: list[Span] = []
    at, done = text.find("@"), 0
    while at >= 0:
        # a match has one @; it starts where the run of its local part does, behind the match before
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        host = _HOST.match(text, at + 1) if start < at else None
        if host:
            out.append(("email", start, host.end()))
            done = host.end()
        at = text.find("@", at + 1)
    if not _DIGIT.search(text):
        return out
    out += [("ip", *m.span()) for m in _IP.finditer(text)
            if all(len(p := x.lstrip("0")) < 4 and int(p or 0) <= 255 for x in m.group().split("."))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            d = _NOT_DIGIT.sub("", m.group())
            if 13 <= len(d) <= 19 and luhn(d):
                out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in _PHONE.finditer(text)
                if 9 <= len(_NOT_DIGIT.sub("", m.group())) <= 15]
    return out


_NUMBER = re.compile(r"(?<![0-9A-Za-z])[+(]?[0-9](?:[ ().\-/]{0,2}[0-9]){6,}+")
_GROUP = re.compile("[0-9]++")
_GOES_ON, _CAME = re.compile(r"[ ().\-/]{0,2}[0-9]"), re.compile(r"[0-9][ ().\-/]{0,2}\Z")
_DOTTED = re.compile(r"(?<![0-9.])[0-9]{1,3}(?: ?\. ?[0-9]{1,3}){3}+(?![0-9.])")
_COLONS = re.compile(r"(?<![0-9A-Za-z:])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){5,7}+(?![0-9A-Za-z:])")
_AT = re.compile(r"@|[(\[{<] ?(?:at|AT) ?[)\]}>]|(?<= )(?:at|AT)(?= )")
_MAIL = re.compile(r"[A-Za-z0-9._%+-]{1,64}+(?: ?[(\[{<] ?(?:at|AT) ?[)\]}>] ?| (?:at|AT) |@)"
                   r"[A-Za-z0-9-]{1,63}+(?:(?: ?[(\[{<] ?(?:dot|DOT) ?[)\]}>] ?| (?:dot|DOT) |\.)[A-Za-z0-9-]{2,63}+){1,4}")


def _numbers(text: str, first: int, last: int) -> Iterator[Span]:
    """The spans between group borders of a run of numbers that a phone or card number could fill, longest first by start.

    Numbers side by side form one run. A group has a digit at least, so a start has at most 19 ends.
    """
    groups = [m.span() for m in _GROUP.finditer(text, first, last)]
    if text[last:last + 1].isascii() and text[last:last + 1].isalpha():  # the last group is part of a word
        groups.pop()
    for i, (a, _) in enumerate(groups):
        n, ends = 0, []
        for _, b in groups[i:i + 19]:
            n += b - groups[i + len(ends)][0]
            if n > 19:
                break
            ends.append((n, b))
        a -= a > first and text[a - 1] in "+("
        for n, b in reversed(ends):
            if 7 <= n <= 15:
                yield "phone", a, b
            if 12 <= n:
                yield "card", a, b


def candidates(text: str) -> list[Span]:
    """High-recall, overlapping candidate spans."""
    out: list[Span] = []
    if _DIGIT.search(text):
        for m in _NUMBER.finditer(text):
            out += _numbers(text, *m.span())
        out += [("ip", *m.span()) for m in _DOTTED.finditer(text)]
        if ":" in text:
            out += [("ip", *m.span()) for m in _COLONS.finditer(text)]
    done = -1
    for m in _AT.finditer(text):
        # every address has an "at"; its local part is the run of at most 64 characters before it
        end = start = m.start() - (m.start() > 0 and m.group() != "@" and text[m.start() - 1] == " ")
        while start > 0 and end - start < 64 and text[start - 1] in _LOCAL:
            start -= 1
        found = _MAIL.match(text, start) if start < end else None
        if found and start != done:
            out.append(("email", *found.span()))
            done = start
    return out


#: Words before a span that speak for or against a kind. Fixed values.
_FOR = {"phone": ("tel", "phone", "call", "fax", "mobile", "cell", "dial"), "card": ("card", "visa", "credit", "amex"),
        "email": ("mail", "contact", "write", "reach"), "ip": ("ip", "host", "server", "address", "addr")}
_TOP_DOMAINS = frozenset("com org net edu gov mil int info biz io co ai app dev eu uk us ca au de fr es it nl be ch at "
                         "pl se no fi dk pt ie cz ru cn jp kr in br mx za nz".split())
_AGAINST = ("version", "isbn", "issn", "page", "vol", "section", "license", "licence", "order", "serial")


_PLAIN = re.compile("[A-Za-z]++(?![0-9._%+-])")  # a local part that could be a word
_DOT_WORD, _AT_WORD, _BRACKET = re.compile(r"\b(?:dot|DOT)\b"), re.compile(r"\b(?:at|AT)\b"), re.compile(r"[()\[\]{}<>]")


def features(text: str, span: Span) -> list[float]:
    """Format and context features of a candidate."""
    kind, a, b = span
    s = text[a:b]
    digits = _NOT_DIGIT.sub("", s)
    numbers = _GROUP.findall(s)
    groups = [len(g) for g in numbers] or [0]
    before, after = text[max(0, a - 24):a].lower(), text[b:b + 1]
    low = sum(len(g) < 6 and int(g) <= 255 for g in numbers)
    mail = kind == "email"
    return [
        float(KINDS.index(kind)), float(b - a), float(len(digits)), float(len(groups)),
        float(max(groups)), float(min(groups)), float(groups[-1]),
        float(s.count("-")), float(s.count(".")), float(s.count(" ")), float(s.count("(")), float(s.count("/")),
        float(s[:1] == "+"), float(13 <= len(digits) <= 19 and luhn(digits)),
        low / len(numbers) if numbers else 0.0,
        float("@" in s), float(mail and len(_DOT_WORD.findall(s))), float(mail and len(_AT_WORD.findall(s))),
        float(len(_BRACKET.findall(s))),
        float(any(w in before for w in _FOR[kind])), float(any(w in before for w in _AGAINST)),
        float(text[a - 1:a].isspace() or a == 0), float(after == "" or after.isspace() or after in ".,;"),
        float(s.count(":")), float(max(map(len, s.split(":")))) if ":" in s else 0.0, float(digits[:1] == "0"),
        float(mail and re.split(r"[^A-Za-z0-9]+", s.rstrip(")]}> "))[-1].lower() in _TOP_DOMAINS),
        float(mail and _PLAIN.match(s) is None),
        float(_CAME.search(text[max(0, a - 3):a]) is not None), float(_GOES_ON.match(text, b) is not None),
    ]


#: Spellings of "@" and "." that the trees learn; a plain dot stays where only "at" is written out.
_SPELT = ((" at ", " dot "), (" (at) ", " (dot) "), ("[at]", "[dot]"), (" [at] ", " [dot] "),
          (" (at) ", "."), ("[at]", "."), (" [AT] ", "."), ("(AT)", "."), ("{at}", "."), (" <at> ", "."), ("( at )", "."),
          (" at ", "."), (" AT ", "."), (" [AT] ", " [DOT] "), ("{at}", "{dot}"), (" AT ", " DOT "))


def _plainer(mail: str, h: int) -> tuple[str, str]:
    """Local part and host of an address, some without what not every address has."""
    user, _, host = mail.partition("@")
    if h & 16:  # not every address has digits
        user, host = re.sub("[0-9]", "", user).strip(".") or "me", re.sub("[0-9]", "", host)
    if h & 32:  # nor a third label
        host = ".".join(host.split(".")[-2:])
    return user, host


def _respelled(text: str, span: Span, h: int, spelt: int = 0) -> tuple[str, Span] | None:
    """A base match in another spelling, in its context."""
    kind, a, b = span
    s = text[a:b]
    if kind == "email":
        user, host = _plainer(s, h)
        at, dot = _SPELT[(h + spelt) % len(_SPELT)]
        new = user + at + host.replace(".", dot)
    elif kind == "phone":
        new = [s.lstrip("+"), s.lstrip("+").split(" ", 1)[-1], s.replace(" ", ".").replace("(", "").replace(")", "").lstrip("+"),
               s.lstrip("+").replace(" ", "-").replace("(", "").replace(")", "")][h % 4]
    elif kind == "ip":
        new = s.replace(".", " . " if h % 2 else " .")
    else:
        d = _NOT_DIGIT.sub("", s)
        new = [".", "/", "  "][h % 3].join(d[i:i + 4] for i in range(0, len(d), 4))
    return text[max(0, a - 200):a] + new + text[b:b + 50], (kind, min(a, 200), min(a, 200) + len(new))


def _hidden(text: str, span: Span) -> bool:
    """Whether a part of a run of numbers would be a base match if it stood alone."""
    kind, a, b = span
    return (kind in ("card", "phone") and bool(_CAME.search(text[max(0, a - 3):a]) or _GOES_ON.match(text, b))
            and (kind, 0, b - a) in base_spans(text[a:b]))


def _side_by_side(text: str, span: Span, h: int) -> Iterator[tuple[list[float], int, int]]:
    """Examples of a base match with a second number beside it: the two are positive, other borders are negative."""
    kind, a, b = span
    s = text[a:b]
    other = ".".join(str(x) for x in hashlib.md5(s.encode()).digest()[:4]) if h & 64 else s.lstrip("+")
    gap = (" ", " ", "/", "  ")[h >> 2 & 3]
    start = min(a, 200)
    new = text[a - start:a] + s + gap + other + text[b:b + 50]
    right = [(kind, start, start + len(s))]
    if not h & 64:
        right.append((kind, start + len(s) + len(gap), start + len(s) + len(gap) + len(other)))
    for c in candidates(new):
        if c in right or (c[0] in ("card", "phone") and start <= c[1] and c[2] <= start + len(s + gap + other)):
            yield features(new, c), int(c in right), int((h >> 8) % 4 == 0)


def _colon_forms(text: str, span: Span, h: int) -> Iterator[tuple[list[float], int, int]]:
    """Examples in the place of a dotted address: eight hexadecimal groups are an address; a hardware address and a date with its time are none."""
    _, a, b = span
    d = hashlib.md5(text[a:b].encode()).digest()
    groups = [f"{d[i] << 8 | d[i + 1]:x}" for i in range(0, 16, 2)]
    for i in range(2, 2 + h % 5):  # addresses have zeros
        groups[i] = "0000" if h & 128 else "0"
    clock = f"{d[0] % 24:02}:{d[1] % 60:02}:{d[2] % 60:02}"
    numbers = ":".join(f"{x % 60:02}" for x in d[:8])
    for new, label in ((":".join(groups), 1), (":".join(f"{x:02x}" for x in d[:6]), 0), (":".join(f"{x:02x}" for x in d[:8]), 0),
                       (f"{1990 + d[3] % 40}:{1 + d[4] % 12:02}:{1 + d[5] % 28:02}:{clock}", 0), (numbers, 0)):
        start = min(a, 200)
        near = text[a - start:a] + new + text[b:b + 50]
        c = ("ip", start, start + len(new))
        if c in candidates(near):
            yield features(near, c), label, int((h >> 8) % 4 == 0)


def training_examples(doc: str) -> Iterator[tuple[list[float], int, int]]:
    """(features, label, half) of a document's candidates; half 1 sets the thresholds."""
    base = base_spans(doc)
    found, by_kind = set(base), {k: _Taken([c for c in base if c[0] == k]) for k in KINDS}
    for c in candidates(doc):
        half = int(hashlib.md5(doc[c[1]:c[2]].encode("utf-8", "replace")).hexdigest()[:2], 16) % 4 == 0
        # a candidate that only overlaps a base span says nothing, nor does one that its neighbours hide from the patterns
        if c in found or not (by_kind[c[0]].touches(c[1], c[2]) or _hidden(doc, c)):
            yield features(doc, c), int(c in found), int(half)
    for c in base:
        h = int(hashlib.md5(doc[c[1]:c[2]].encode("utf-8", "replace")).hexdigest()[:4], 16)
        text, span = _respelled(doc, c, h)
        near = candidates(text)
        if span in near:
            yield features(text, span), 1, int((h >> 8) % 4 == 0)
        for spelt in range(4, 16, 4) if c[0] == "email" else ():  # one of each four spellings
            text, span = _respelled(doc, c, h, spelt)
            if span in candidates(text):
                yield features(text, span), 1, int((h >> 8) % 4 == 0)
        if c[0] in ("card", "phone"):  # parts of a number are none
            for d in near:
                if d != span and span[1] <= d[1] and d[2] <= span[2]:
                    yield features(text, d), 0, int((h >> 8) % 4 == 0)
            yield from _side_by_side(doc, c, h)
        if c[0] == "ip":
            yield from _colon_forms(doc, c, h)
        if c[0] == "email":  # ordinary words around "at" and "dot" are no address
            w = re.findall("[A-Za-z]{2,}", doc[max(0, c[1] - 80):c[1]])[-3:]
            if len(w) == 3 and w[2].lower() not in _TOP_DOMAINS:
                text = f"{w[0]} at {w[1]} dot {w[2]} " if h & 32 else f"{w[0]} at {w[1]} dot {w[0]} dot {w[2]} "
                yield features(text, ("email", 0, len(text) - 1)), 0, int((h >> 8) % 4 == 0)
                text = f"{w[0]} at {w[1]}.{w[2]} "
                yield features(text, ("email", 0, len(text) - 1)), 0, int((h >> 8) % 4 == 0)
            for k in (0, 16, 32, 48) if w else ():  # a host that something happens at
                text = f"{w[-1]} at {_plainer(doc[c[1]:c[2]], k)[1]} "
                yield features(text, ("email", 0, len(text) - 1)), 0, int((h >> 8) % 4 == 0)


class _Taken:
    """Disjoint intervals in order; says whether a span touches one."""

    def __init__(self, spans: list[Span]):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for _, a, b in sorted(spans, key=lambda c: c[1]):
            if self.ends and a <= self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], b)
            else:
                self.starts.append(a)
                self.ends.append(b)

    def touches(self, a: int, b: int) -> bool:
        i = bisect_left(self.starts, b) - 1
        return i >= 0 and self.ends[i] > a

    def add(self, a: int, b: int) -> None:
        i = bisect_left(self.starts, a)
        self.starts.insert(i, a)
        self.ends.insert(i, b)


class SpanModel:
    """The trees and the threshold of each kind."""

    def __init__(self, trees: BoostedTrees, limits: dict[str, float]):
        self.trees, self.limits = trees, limits

    def added(self, text: str, base: list[Span]) -> list[Span]:
        """Selected candidates that touch no base span and no better candidate."""
        taken = _Taken(base)
        own = [c for c in candidates(text) if self.limits[c[0]] <= 1.0 and not taken.touches(c[1], c[2])]
        if not own:
            return []
        p = np.concatenate([self.trees.predict(np.array([features(text, c) for c in own[i:i + SCORED]]))
                            for i in range(0, len(own), SCORED)])
        out: list[Span] = []
        for i in np.argsort(-p, kind="stable").tolist():
            c = own[i]
            if p[i] >= self.limits[c[0]] and not taken.touches(c[1], c[2]):
                out.append(c)
                taken.add(c[1], c[2])
        return out

    def spans(self, text: str) -> tuple[list[Span], list[Span]]:
        """(base spans, all spans), each by kind, then start."""
        base = base_spans(text)
        return base, sorted(base + self.added(text, base), key=lambda c: (KINDS.index(c[0]), c[1]))


def _sample(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """About TRAIN_DOCS documents, by hashes of ids and texts (null ids share the former)."""
    n = docs.count()
    h = F.pmod(F.xxhash64(F.lit(7), F.coalesce(F.col(doc_id).cast("string"), F.lit("")),
                          F.coalesce(F.col(text), F.lit(""))), F.lit(1 << 30))
    return docs.where(h < int((1 << 30) * min(1.0, TRAIN_DOCS / max(n, 1)))).select(F.col(text).alias("text"))


def _held_out(docs: DataFrame, text: str, trees: BoostedTrees) -> DataFrame:
    """Per kind and bin of log odds: the held-out examples of all documents and how many are positive."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            counts: dict[tuple[int, int], list[int]] = {}
            rest = (x for t in b.column(0).to_pylist() for x in training_examples(t or "") if x[2])
            while rows := list(islice(rest, SCORED)):
                x = np.array([r[0] for r in rows])
                p = np.clip(trees.predict(x), 1e-9, 1 - 1e-9)
                bins = np.floor(np.log(p / (1 - p)) * ODDS_BINS).astype(int)
                for k, at, r in zip(x[:, 0].astype(int).tolist(), bins.tolist(), rows):
                    c = counts.setdefault((k, at), [0, 0])
                    c[0] += 1
                    c[1] += r[1]
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in counts], pa.int32()), pa.array([k[1] for k in counts], pa.int32()),
                 pa.array([c[0] for c in counts.values()], pa.int64()), pa.array([c[1] for c in counts.values()], pa.int64())],
                ["kind", "bin", "n", "good"])

    got = docs.select(F.col(text).alias("text")).mapInArrow(run, "kind int, bin int, n long, good long")
    return got.groupBy("kind", "bin").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))


def _bounded(examples: DataFrame) -> DataFrame:
    """Examples (x, y): of each kind all, or about TRAIN_ROWS (twice that at most) in the same proportions."""
    rows = materialize(examples.withColumn("kind", F.col("x")[0].cast("int")), "pii-examples", TEXT_ROWS)
    many = rows.groupBy("kind").count().where(F.col("count") > TRAIN_ROWS).collect()  # a row per kind at most
    for r in many:
        own = rows.where(F.col("kind") == r["kind"]).groupBy("x", "y").agg(F.first("kind").alias("kind"), F.count("*").alias("n"))
        some = own.withColumn("h", F.xxhash64("x", "y")).orderBy("h").limit(TRAIN_ROWS)
        copies = F.greatest(F.lit(1), F.floor(F.col("n") * (TRAIN_ROWS / r["count"]))).cast("int")
        some = some.select("x", "y", "kind", F.explode(F.sequence(F.lit(1), copies)).alias("copy")).drop("copy")
        rows = rows.where(F.col("kind") != r["kind"]).unionByName(some)
    return rows.select("x", "y")


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> SpanModel:
    """Trees from the candidates of about TRAIN_DOCS documents, thresholds from those of all, found on Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            rows = [x for t in b.column(0).to_pylist() for x in training_examples(t or "") if not x[2]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in rows], pa.list_(pa.float64())), pa.array([x[1] for x in rows], pa.int32())], ["x", "y"])

    got = _bounded(_sample(docs, doc_id, text).mapInArrow(run, "x array<double>, y int")).toPandas()
    limits = dict.fromkeys(KINDS, 2.0)
    if not len(got) or got["y"].nunique() < 2:
        return SpanModel(BoostedTrees(), limits)
    x, y = np.array(got["x"].tolist()), got["y"].to_numpy()
    order = np.lexsort((*x.T, y))  # the rows' order must not matter
    trees = BoostedTrees().fit(x[order], y[order].astype(float))
    held = _held_out(docs, text, trees).toPandas()  # some thousand bins a kind at most
    for k, kind in enumerate(KINDS):
        own = held[held["kind"] == k].sort_values("bin", ascending=False)
        fit_at = np.flatnonzero(own["good"].cumsum() >= PRECISION * own["n"].cumsum()) if own["good"].any() else []
        if len(fit_at):
            limits[kind] = float(max(1 / (1 + np.exp(-own["bin"].iloc[fit_at[-1]] / ODDS_BINS)), 0.5))
    return SpanModel(trees, limits)


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", model: SpanModel | None = None) -> DataFrame:
    """Per document: doc_id, base counts by kind, base_sha256 and all spans."""
    model = model or fit(docs, doc_id, text)
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            counts, shas, alls = {k: [] for k in KINDS}, [], []
            for t in b.column(1).to_pylist():
                base, every = model.spans(t or "")
                for k in KINDS:
                    counts[k].append(sum(c[0] == k for c in base))
                shas.append(hashlib.sha256(_joined(base).encode()).hexdigest())
                alls.append(_joined(every))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(counts[k], pa.int64()) for k in KINDS), pa.array(shas, pa.string()),
                 pa.array(alls, pa.string())],
                ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, f"doc_id {kind}, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string")


def redact_text(text: str, spans: list[Span]) -> str:
    """The text with each span (the first of those that overlap) replaced by its kind in brackets."""
    out, at = [], 0
    for k, a, b in sorted(spans, key=lambda c: (c[1], -c[2])):
        if a < at:
            if b > at:  # the rest of a span that overlaps the last one goes too
                at = b
            continue
        out += [text[at:a], f"[{k}]"]
        at = b
    return "".join(out) + text[at:]


def redact(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", model: SpanModel | None = None) -> DataFrame:
    """The documents with their spans redacted in ``text``; null texts stay null."""
    model = model or fit(docs, doc_id, text)
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, text):
            new = [None if t is None else redact_text(t, model.spans(t)[1]) for t in b.column(at).to_pylist()]
            yield b.set_column(at, b.schema.field(at), pa.array(new, b.column(at).type))

    return docs.mapInArrow(run, docs.schema)
